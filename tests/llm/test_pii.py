import hashlib
import random
import re

from pyspark.sql import functions as F

from postlake.llm import pii as q

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    n = [int(c) for c in digits[::-1]]
    return sum(n[::2] + [x * 2 - 9 * (x > 4) for x in n[1::2]]) % 10 == 0


def base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_base_spans_equal_plain_matching(spark):
    rng = random.Random(3)
    alphabet = " +-.()@ab_1234567890\n:é🙂"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(300))) for _ in range(200)]
    texts += ["a@b.c_d@e.f.g", "x@y.z.@k.l", "1.2.3.4.5.6.7.8", "9" * 5000, "1.2.3.4 " * 3000, "a" * 5000 + "@", None, "", "4111 1111 1111 1111"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = q.find_spans(rows, "text", "f").select("i", q.listing(F.col("f_base")).alias("s")).collect()
    assert {r.i: r.s for r in found} == {i: base(t) for i, t in enumerate(texts)}


def test_added_kinds_need_checksum_or_context(spark):
    texts = [
        "IBAN GB82 WEST 1234 5698 7654 32.", "IBAN GB83 WEST 1234 5698 7654 32.", "phone 555-123-4567", "part 555-123-4567",
        "his ssn 123-45-6789", "number 123-45-6789", "tel +1 (555) 123-4567",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    kinds = {r.i: [s.kind for s in r.f] for r in q.find_spans(rows, "text", "f").collect()}
    assert kinds == {0: ["iban"], 1: [], 2: ["local_phone"], 3: [], 4: ["ssn"], 5: [], 6: ["phone"]}


def test_one_context_word_serves_a_list_and_may_follow(spark):
    numbers = [f"555-{100 + i}-{4567 + i}" for i in range(12)]
    texts = [
        "Call 555-123-4567 or 555-987-6543", "tel: 555-123-4567, 555-987-6543, (555) 111-2222.", "Call " + "; ".join(numbers),
        "SSN 123-45-6789, 000-12-3456 and 234-56-7890", "social security:\n123-45-6789\n234-56-7890\n345-67-8901",
        "555-123-4567 is my phone", "123-45-6789 and 234-56-7890 (SSN)", "part 555-123-4567 or 555-987-6543",
        "Call me. " + "Nothing else is said about any number here at all. " + "555-123-4567", "ssn " + "123-45-6789\n" * 300,
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = {r.i: r.f for r in q.find_spans(rows, "text", "f").collect()}
    kinds = {i: [s.kind for s in f] for i, f in found.items()}
    assert [len(kinds[i]) for i in range(9)] == [2, 3, 12, 2, 3, 1, 2, 0, 0] and len(kinds[9]) == 300
    assert [texts[2][s.start : s.end] for s in found[2]] == numbers
    assert [texts[3][s.start : s.end] for s in found[3]] == ["123-45-6789", "234-56-7890"]


def test_iban_ends_where_its_country_says(spark):
    de, gb, fr = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "FR14 2004 1010 0505 0001 3M02 606"
    cases = [
        (f"{de} BIC COBADEFFXXX", [de]), (f"{de} Please pay", [de]), (f"{de} 2024-01-01", [de]), (f"{gb} AND more", [gb]),
        (f"{gb} BIC NWBKGB2L", [gb]), (f"{de} {gb} {fr} A", [de, gb, fr]), (f"BE12 {gb}", [gb]), (f"ZZ12 3456 7890 {de}", [de]),
        (f"{de}X", []), (f"{de[:-1]}1 BIC", []), (f"é🙂 {gb}, 2024. {fr} Y{de}", [gb, fr]), (f"{de}\n" * 300, [de] * 300),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, text string")
    found = {r.i: [s for s in r.f if s.kind == "iban"] for r in q.find_spans(rows, "text", "f").collect()}
    assert [[t[s.start : s.end] for s in found[i]] for i, (t, _) in enumerate(cases)] == [want for _, want in cases]
    near = spark.createDataFrame([(f"{gb} is my account",), (f"{gb} is mine",)], "text string")
    assert [r.f[0].score for r in q.find_spans(near, "text", "f").collect()] == [0.95, 0.7]
    out = q.redacted(spark.createDataFrame([(f"pay {de} BIC X, {gb} AND",)], "text string"), "text").collect()
    assert out[0].text == "pay [IBAN] BIC X, [IBAN] AND"


def test_redaction(spark):
    long = "é🙂x" * 2000
    texts = ["mail a@b.co or 1.2.3.4!", f"{long} a@b.co {long}", "none", None, "x@1.2.3.4 end"]
    out = [r.text for r in q.redacted(spark.createDataFrame([(t,) for t in texts], "text string"), "text").collect()]
    assert out == ["mail [EMAIL] or [IP]!", f"{long} [EMAIL] {long}", "none", None, "[EMAIL] end"]


def test_query_stage_and_empty_tables(spark, small_dir, empty_dir, awkward, awkward_rows, plan_of):
    out = q.op3_pii(spark, small_dir)
    assert out.count() == len(awkward_rows)
    text = dict(awkward_rows)
    for r in out.collect():
        if r.doc_id is not None:
            assert r.base_sha256 == hashlib.sha256(base(text[r.doc_id]).encode()).hexdigest()
    assert "Python" not in plan_of(out) and "Arrow" not in plan_of(out)
    assert q.op3_pii(spark, empty_dir).count() == 0
    kept = q.stage(spark, awkward, small_dir)
    assert [f.name for f in kept.schema] == awkward.columns and kept.count() == awkward.count()
