"""IBANs before an upper-case word or number, and cues of any case."""

import pytest

from lamella.llm import pii


@pytest.mark.parametrize("text, iban", [
    ("IBAN AT611904300234573201 BIC GIBAATWW", "AT611904300234573201"),
    ("IBAN: ES91 2100 0418 4502 0005 1332 EUR 20", "ES91 2100 0418 4502 0005 1332"),
    ("Iban DE89 3704 0044 0532 0130 00 and", "DE89 3704 0044 0532 0130 00"),
])
def test_account_is_found(text, iban):
    at = text.index(iban)
    assert (at, 4, at + len(iban)) in pii.find(text, pii.automaton())
