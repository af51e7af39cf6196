"""Tar shards as a Spark data source: ``format('tarshards')``.

A shard is a tar of ``{slide_id}.features.npy`` and ``{slide_id}.coords.npy``.
Reading makes one partition per shard and streams its members, so memory is
bounded by one slide. Writing expects each shard's rows in one task, ordered by
slide and tile (see ``sinks.shard_sink``).
"""

from __future__ import annotations

import io
import posixpath
import re
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from lamella.functions.precision import bfloat16_bits, bfloat16_values
from lamella.session import open_path

SCHEMA = ("model string, group string, shard_file string, slide_id string, tile_idx int,"
          " features array<float>, x bigint, y bigint, precision string")
FEATURES, COORDS = ".features.npy", ".coords.npy"
OBJECT_STORES = ("s3", "gcs", "abfs")


def encode_features(values: np.ndarray, precision: str) -> np.ndarray:
    """Stored array: bfloat16 as its raw bits in uint16, other precisions as themselves."""
    if precision == "bfloat16":
        return bfloat16_bits(values)
    return values.astype(np.float16 if precision == "float16" else np.float32)


def decode_features(stored: np.ndarray) -> tuple[np.ndarray, str]:
    matrix = stored[None, :] if stored.ndim == 1 else stored
    if matrix.dtype == np.uint16:
        return bfloat16_values(matrix), "bfloat16"
    return matrix.astype(np.float32), str(matrix.dtype)


def revision_of(name: str) -> tuple[str, int]:
    """Stem and revision of a shard's file name (0 for one that was never continued)."""
    found = re.fullmatch(r"(.*?)(?:\.r(\d+))?\.tar", name)
    return (found[1], int(found[2] or 0)) if found else (name, 0)


def _npy(array: np.ndarray) -> bytes:
    buffer = io.BytesIO()
    np.save(buffer, array)
    return buffer.getvalue()


def _member(name: str, payload: bytes) -> tuple[tarfile.TarInfo, io.BytesIO]:
    """Tar entry with fixed metadata, so equal content gives equal bytes."""
    info = tarfile.TarInfo(name)
    info.size = len(payload)
    return info, io.BytesIO(payload)


@dataclass
class ShardFile(InputPartition):
    path: str
    model: str
    group: str
    name: str

    def __init__(self, path: str, model: str, group: str, name: str) -> None:
        super().__init__(path)
        self.path, self.model, self.group, self.name = path, model, group, name


class ShardReader(DataSourceReader):
    def __init__(self, root: str, schema) -> None:
        self.root = root
        self.columns = schema.fieldNames()

    def partitions(self) -> list[ShardFile]:
        filesystem, base = open_path(self.root)
        found = filesystem.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True))
        shards, newest = [], {}
        for entry in sorted(f.path for f in found if f.type == pafs.FileType.File and f.path.endswith(".tar")):
            parts = entry[len(base):].strip("/").split("/")
            if len(parts) == 3 and not parts[0].startswith("_"):
                shards.append(ShardFile(entry, *parts))
                number, revision = revision_of(parts[2])
                key = (parts[0], parts[1], number)
                newest[key] = max(newest.get(key, 0), revision)
        # A continued shard holds all that its earlier revisions hold.
        return [s for s in shards if revision_of(s.name)[1] == newest[s.model, s.group, revision_of(s.name)[0]]]

    def read(self, partition: ShardFile) -> Iterator[pa.RecordBatch]:
        filesystem, _ = open_path(self.root)
        with filesystem.open_input_stream(partition.path) as stream, tarfile.open(fileobj=stream, mode="r|") as tar:
            slide, features, coords = None, None, None
            for member in tar:
                name, suffix = next(((member.name[:-len(s)], s) for s in (FEATURES, COORDS)
                                     if member.name.endswith(s)), (None, None))
                if name is None:
                    continue
                if slide is not None and name != slide:
                    yield from self._rows(partition, slide, features, coords)
                    features = coords = None
                slide = name
                array = np.load(io.BytesIO(tar.extractfile(member).read()))
                features, coords = (array, coords) if suffix == FEATURES else (features, array)
            if slide is not None:
                yield from self._rows(partition, slide, features, coords)

    def _rows(self, shard: ShardFile, slide: str, features, coords) -> Iterator[pa.RecordBatch]:
        if features is None:
            return
        matrix, precision = decode_features(features)
        for start in range(0, len(matrix), 4096):
            part = matrix[start:start + 4096]
            n, width = part.shape
            at = None if coords is None else np.atleast_2d(coords)[start:start + n]
            offsets = pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32))
            data = {
                "model": pa.array([shard.model] * n), "group": pa.array([shard.group] * n),
                "shard_file": pa.array([shard.name] * n), "slide_id": pa.array([slide] * n),
                "tile_idx": pa.array(np.arange(start, start + n, dtype=np.int32)),
                "features": pa.ListArray.from_arrays(offsets, pa.array(part.ravel(), pa.float32())),
                "x": pa.nulls(n, pa.int64()) if at is None else pa.array(at[:, 0].astype(np.int64)),
                "y": pa.nulls(n, pa.int64()) if at is None else pa.array(at[:, 1].astype(np.int64)),
                "precision": pa.array([precision] * n)}
            yield pa.RecordBatch.from_pydict({c: data[c] for c in self.columns})


@dataclass
class Written(WriterCommitMessage):
    """(written path, final path) of the shards of one task."""

    files: list = field(default_factory=list)


class ShardWriter(DataSourceArrowWriter):
    """Tasks do the writing and the size check; the commit only renames, where renames are cheap.

    In an object store a file appears whole or not at all, and a move would copy
    it, so tasks write to the final name there. Elsewhere they write to a staging
    folder.
    """

    def __init__(self, root: str, coords: bool) -> None:
        self.root = root.rstrip("/")
        self.coords = coords
        self.staging = f"_staging_{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        filesystem, base = open_path(self.root)
        direct = filesystem.type_name in OBJECT_STORES
        message, shard, tar, stream, target = Written(), None, None, None, None
        done: set = set()

        def close() -> None:
            nonlocal tar
            if tar is None:
                return
            tar.close()
            written = stream.tell()
            stream.close()
            if filesystem.get_file_info(target).size != written:
                raise IOError(f"{target} has another size than was written")
            message.files.append((target, f"{base}/{'/'.join(shard)}"))
            done.add(shard)
            tar = None

        for key, slide, precision, matrix, coords in self._slides(iterator):
            if key != shard:
                close()
                if key in done:
                    raise ValueError(f"rows of shard {'/'.join(key)} are not together; use shard_sink")
                shard = key
                target = f"{base}/{'/'.join(key)}" if direct else f"{base}/{self.staging}/{uuid.uuid4().hex}.tar"
                filesystem.create_dir(posixpath.dirname(target), recursive=True)
                stream = filesystem.open_output_stream(target)
                tar = tarfile.open(fileobj=stream, mode="w|")
                self._copy_base(filesystem, f"{base}/{'/'.join(key)}", tar)
            tar.addfile(*_member(slide + FEATURES, _npy(encode_features(matrix, precision))))
            if coords is not None:
                tar.addfile(*_member(slide + COORDS, _npy(coords)))
        close()
        return message

    def _copy_base(self, filesystem: pafs.FileSystem, final: str, tar: tarfile.TarFile) -> None:
        """The members of the revision before, one at a time."""
        folder, name = posixpath.split(final)
        stem, revision = revision_of(name)
        if revision:
            before = f"{folder}/{stem}.r{revision - 1}.tar" if revision > 1 else f"{folder}/{stem}.tar"
            with filesystem.open_input_stream(before) as held, tarfile.open(fileobj=held, mode="r|") as old:
                for member in old:
                    tar.addfile(member, old.extractfile(member))

    def _slides(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Complete slides of consecutive rows: only one slide is held at a time."""
        current, blocks, places = None, [], []

        def finish():
            shard, slide, precision = current[:3], current[3], current[4]
            places_ok = self.coords and not any(p is None for p in places)
            return shard, slide, precision, np.concatenate(blocks), np.concatenate(places) if places_ok else None

        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = list(zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist()
                              for c in ("model", "group", "shard_file", "slide_id", "precision")]))
            features = batch.column(batch.schema.get_field_index("features"))
            x, y = (batch.column(batch.schema.get_field_index(c)) for c in ("x", "y"))
            start = 0
            for stop in range(1, len(keys) + 1):
                if stop < len(keys) and keys[stop] == keys[start]:
                    continue
                if current is not None and keys[start] != current:
                    yield finish()
                    blocks, places = [], []
                current = keys[start]
                part = features.slice(start, stop - start)
                blocks.append(np.asarray(part.flatten(), dtype=np.float32).reshape(stop - start, -1))
                px, py = x.slice(start, stop - start), y.slice(start, stop - start)
                known = px.null_count == 0 and py.null_count == 0
                places.append(np.stack([np.asarray(px), np.asarray(py)], 1).astype(np.int64) if known else None)
                start = stop
        if current is not None:
            yield finish()

    def commit(self, messages: list[Written]) -> None:
        filesystem, base = open_path(self.root)
        moves = [pair for message in filter(None, messages) for pair in message.files if pair[0] != pair[1]]
        taken = [info.path for info in filesystem.get_file_info([final for _, final in moves])
                 if info.type != pafs.FileType.NotFound] if moves else []
        if taken:
            raise FileExistsError(f"{len(taken)} shards exist already, among them {min(taken)}")
        for folder in sorted({posixpath.dirname(final) for _, final in moves}):
            filesystem.create_dir(folder, recursive=True)
        for written, final in moves:
            filesystem.move(written, final)
        self._drop_staging(filesystem, base)

    def abort(self, messages: list[Written]) -> None:
        filesystem, base = open_path(self.root)
        for message in filter(None, messages):
            for written, _ in message.files:
                if filesystem.get_file_info(written).type == pafs.FileType.File:
                    filesystem.delete_file(written)
        self._drop_staging(filesystem, base)

    def _drop_staging(self, filesystem: pafs.FileSystem, base: str) -> None:
        folder = f"{base}/{self.staging}"
        if filesystem.get_file_info(folder).type == pafs.FileType.Directory:
            filesystem.delete_dir(folder)


class TarShards(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tarshards"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ShardReader:
        return ShardReader(self.options["path"], schema)

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options["path"], self.options.get("coords", "true") == "true")


def register(spark) -> None:
    spark.dataSource.register(TarShards)


def shard_scan(spark, path: str):
    """Tile rows of all shards below ``path`` (``<model>/<group>/<number>.tar``)."""
    register(spark)
    return spark.read.format("tarshards").load(path)


def shard_members(spark, path: str):
    """(shard, member) of every tar entry, without decoding payloads; an empty shard gives a NULL member."""
    register(spark)
    from lamella.sources.files import file_listing
    from pyspark.sql import functions as F

    listing = file_listing(spark, path, [".tar"]).select("path")

    def members(batches):
        import pandas as pd
        for batch in batches:
            for shard in batch["path"]:
                filesystem, inner = open_path(shard)
                with filesystem.open_input_stream(inner) as stream, tarfile.open(fileobj=stream, mode="r|") as tar:
                    names = [m.name for m in tar] or [None]
                yield pd.DataFrame({"shard": shard, "member": pd.Series(names, dtype=object)})

    return listing.repartition(F.col("path")).mapInPandas(members, "shard string, member string")
