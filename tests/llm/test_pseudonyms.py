"""Pseudonyms of phone and bank account numbers beside other text."""

import re

import pytest
from pyspark.sql import functions as F

from flowruns.llm.pseudonyms import pseudonymized


def changed(spark, texts, reveal=False):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.text for r in pseudonymized(rows, "k", reveal=reveal).orderBy("row.doc_id").select("text").collect()]


@pytest.mark.parametrize("number,other_spelling", [
    ("+1 (319) 555-5132", "+13195555132"),
    ("+44 20 7946 0958", "+44 (20) 79460958"),
    ("+33 1 23 45 67 89", "+33123456789"),
    ("+380 44 123 45 67", "+380441234567"),
    ("+49 30 12345678", "+493012345678"),   # no one length: by groups
    ("+353 86 123 4567", "+353861234567"),
    ("+86 138 1234 5678", "+8613812345678"),
])
def test_a_phone_number_is_one_value_whatever_follows(spark, number, other_spelling):
    after = [", ok", " 42 apples", " 7", " 2024", "", "\n8 10", " or 5 9"]
    out = changed(spark, [f"call {number}{t}" for t in after] + [other_spelling])
    found = {o[len("call "):len(o) - len(t)] for o, t in zip(out, after)}
    assert len(found) == 1 and all(o.startswith("call ") and o.endswith(t) for o, t in zip(out, after))
    new = found.pop()
    assert new != number and re.sub("[0-9]", "9", new) == re.sub("[0-9]", "9", number)
    assert re.sub("[^0-9]", "", new) == re.sub("[^0-9]", "", out[-1])
    assert changed(spark, out, reveal=True) == [f"call {number}{t}" for t in after] + [other_spelling]


def valid(iban):
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def test_bank_account_numbers(spark):
    good = ["GB29 NWBK 6016 1331 9268 19", "DE89370400440532013000", "NO93 8601 1117 947", "FR14 2004 1010 0505 0001 3M02 606", "GB29NWBK60161331926819"]
    texts = [f"to {g} CASH 12" for g in good]
    out = changed(spark, texts)
    new = [o[3:-len(" CASH 12")] for o in out]
    assert all(o.endswith(" CASH 12") for o in out) and all(valid(n) and n != g for n, g in zip(new, good))
    assert [re.sub("[A-Z]", "A", re.sub("[0-9]", "9", n)) for n in new] == [re.sub("[A-Z]", "A", re.sub("[0-9]", "9", g)) for g in good]
    assert all(n[:2] == g[:2] for n, g in zip(new, good)) and new[0].replace(" ", "") == new[4]
    assert changed(spark, out, reveal=True) == texts
    bad = ["GB30 NWBK 6016 1331 9268 19", "DE8937040044053201300", "ZZ89370400440532013000", "xDE89370400440532013000"]
    assert changed(spark, bad) == bad


def test_empty_table_long_text_and_clashing_names(spark):
    docs = spark.createDataFrame([("+1 319 555 5132", 1, 2, 3, 4)], "text string, row int, found int, new int, n_found int")
    out = pseudonymized(docs, "k").first()
    assert (out.row.row, out.row.found, out.row.new, out.row.n_found, out.n_found) == (1, 2, 3, 4, 1) and out.text != "+1 319 555 5132"
    assert pseudonymized(docs.limit(0), "k").count() == 0
    long = docs.select(F.expr("concat(repeat('word ', 400000), '+1 319 555 5132')").alias("text"))
    assert pseudonymized(long, "k").select(F.substring("text", -15, 15)).first()[0] == out.text
