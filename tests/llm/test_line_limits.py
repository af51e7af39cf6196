"""The pipeline's line rule on a small host, a middle one and a hot one."""

import corpus_pipeline


def test_planted_line_goes_at_every_host_size(spark):
    words = "one two three four five six seven eight nine ten"
    line, rare = "All rights reserved by the owners of this page", "Kept by three only"
    rows = []
    for host, size, held in (("small", 8, 5), ("middle", 300, 20), ("hot", 60_000, 1100)):
        for i in range(size):
            own = [f"{host} {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}{chr(97 + i // 17576)} {words}"]
            rows.append(("\n".join(own + [line] * (i < held) + [rare] * (i < 3)), host))
    docs = spark.createDataFrame(rows, "text string, source string").selectExpr("monotonically_increasing_id() doc_id", "*")
    kept = corpus_pipeline.quality_rules(spark, docs, "").cache()
    assert kept.count() == len(rows)
    assert kept.filter(kept.text.contains(line)).count() == 0
    assert kept.filter(kept.text.contains(rare)).count() == 9
