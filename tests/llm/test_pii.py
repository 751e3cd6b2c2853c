from pathlib import Path

import llm_brute as brute
import pytest

from tidelane.llm.pii import BASE, find_pii

SF = Path("/root/testdata/sf0.001/documents.parquet")

CASES = [
    "mail a.b@c.d or x@y, z@q.r.s.; a@b.c%x@d.e and ..@x.y @a.b a@b.c@d.e",
    "ip 1.2.3.4 10.0.0.256 001.02.3.4.5 1.2.3 999.1.1.1.1.1 1.2.3.4.5.6.7.8 0000000255.0.0.0",
    "card 4111 1111 1111 1111 4111-1111-1111-1112 4111 1111 1111 1111 7 79927398713 5500005555555559 0000 0000 0000 0000 000",
    "+1 (555) 010-2030 +49 30 1234567 +1 23 +12345678901234567 ++4 5 6 7 8 9 0 1 + 1 +1-2-3-4-5-6-7-8) tel",
    "é😀 a@b.co 😀 +15550102030 x 1.1.1.1", "", None, "9" * 5000, "1." * 3000, "a" * 5000, "a.a@" * 2000, "a@b" + ".c" * 6000, "+" * 3000, "+1" + " " * 4000 + "x",
    "1 " * 6000, "4111 1111 1111 1111", "a@b.c\n1.2.3.4\n+1 555 010 2030",
]


def spans(row):
    return [f"{s.kind}:{s.start}:{s.end}" for s in row.pii if s.kind in BASE]


def test_cases_equal_plain_search(spark):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(CASES)], "doc_id long, text string, pii string")
    got = {r.doc_id: spans(r) for r in find_pii(frame).collect()}
    for i, text in enumerate(CASES):
        assert got[i] == brute.base_spans(text), text


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_table_equals_plain_search(spark):
    rows = find_pii(spark.read.parquet(str(SF))).select("text", "pii").collect()
    assert rows and sum(map(len, map(spans, rows))) > 0
    for r in rows:
        assert spans(r) == brute.base_spans(r.text)


def test_account_codes_and_context(spark):
    texts = ["IBAN: DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "GB82WEST12345698765433", "visa 4111111111111111", "4111111111111111"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: {s.kind: s for s in r.pii} for r in find_pii(frame).collect()}
    assert (got[0]["iban"].start, got[0]["iban"].end, got[0]["iban"].score) == (6, 33, 1.0)
    assert got[1]["iban"].score == 0.9 and "iban" not in got[2]
    assert got[3]["card"].score == 1.0 and got[4]["card"].score == 0.8


def test_account_codes_amid_capitals_digits_and_codes(spark):
    german, british, none = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "XX1234567890123"
    rest = 98 - int("".join(str(int(c, 36)) for c in "1234567890ABCZZ00")) % 97
    unknown = f"ZZ{rest:02} 1234 5678 90AB C"
    cases = [
        f"{german} Please wait", f"{british} The", f"{german} AND", f"{british} 2024", f"{german} {british} {german}", f"{none} {german}",
        f"AT12 {german} A", f"{german}9 x{german} {german}x", f"é😀 {british}, {british}.", unknown + " THEN 20", f"{german} 12345678901234567890 {british} X1",
        f"AT12 {'AB12 CD34 ' * 2000}{german} A",
    ]
    wanted = [
        [german], [british], [german], [british], [german, british, german], [german], [german], [], [british, british], [unknown],
        [german, british], [german],
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string")
    for r in find_pii(frame).collect():
        found = [(s.start, r.text[s.start : s.end]) for s in r.pii if s.kind == "iban"]
        assert [code for _, code in found] == wanted[r.doc_id], r.text[:100]


def test_context_words_are_whole_and_on_both_sides(spark):
    texts = ["ship 1.2.3.4", "ip 1.2.3.4", "1.2.3.4 is the server", "discard 4111111111111111", "4111111111111111, my visa", "GB82WEST12345698765432 is my bank"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert [r.pii[-1].score for r in find_pii(frame).sort("doc_id").collect()] == [0.5, 0.9, 0.9, 0.8, 1.0, 1.0]


def test_many_matches_in_one_text(spark):
    text = "a@b.c 1.2.3.4 " * 50_000 + "GB82WEST12345698765432 " * 300
    row = find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).select("pii").first()
    starts = {kind: [s.start for s in row.pii if s.kind == kind] for kind in ("email", "ip", "iban")}
    assert starts["email"] == list(range(0, 700_000, 14)) and starts["ip"] == list(range(6, 700_000, 14))
    assert starts["iban"] == [700_000 + 23 * i for i in range(300)]


def test_empty(spark):
    assert find_pii(spark.createDataFrame([], "doc_id long, text string")).collect() == []
