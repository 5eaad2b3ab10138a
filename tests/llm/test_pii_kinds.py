"""Personal data outside the training recipe: hand-labelled sentences, long runs, and ids that are null or repeated."""

from collections import Counter

from kinweave.llm import pii
from kinweave.llm import spans as S

#: Kind, sentence, and the span that a reader would redact (none: a look-alike).
LABELLED = [
    ("local_phone", "Please call the office on 212-555-0147 before noon.", "212-555-0147"),
    ("local_phone", "My mobile is (415) 555-2671, ask for Ann.", "(415) 555-2671"),
    ("local_phone", "Tel: 617.555.0199", "617.555.0199"),
    ("local_phone", "You can dial 303 555 0112 for help", "303 555 0112"),
    ("local_phone", "fax 702-555-0188 is always on", "702-555-0188"),
    ("local_phone", "Our order 212-555-0147 was delayed", None),
    ("local_phone", "Part 303-555-0112 does not fit", None),
    ("local_phone", "invoice 617-555-0199 is unpaid", None),
    ("local_phone", "The serial 702-555-0188 is on the back", None),
    ("spelt_email", "Write to jane (at) example (dot) org for details", "jane (at) example (dot) org"),
    ("spelt_email", "contact: m.ray [at] mail.net", "m.ray [at] mail.net"),
    ("spelt_email", "reach me under tom_b(at)post(dot)de", "tom_b(at)post(dot)de"),
    ("spelt_email", "mail info [at] shop [dot] com today", "info [at] shop [dot] com"),
    ("spelt_email", "measured 25 (at) 10.50 degrees", None),
    ("spelt_email", "version 12 (at) 44.10 of the file", None),
    ("ssn", "Her social security number is 219-09-9999.", "219-09-9999"),
    ("ssn", "SSN: 457-55-5462", "457-55-5462"),
    ("ssn", "social security 078-05-1120 was leaked", "078-05-1120"),
    ("ssn", "part 219-09-9999 is sold out", None),
    ("ssn", "ticket ref 457-55-5462 closed", None),
    ("ssn", "order 078-05-1120 left the house", None),
    ("iban", "Pay to IBAN DE44 5001 0517 5407 3249 31 by Friday", "DE44 5001 0517 5407 3249 31"),
    ("iban", "my account is GB29 1234 6016 1331 9268 19", "GB29 1234 6016 1331 9268 19"),
    ("iban", "bank transfer to FR76 3000 6000 0112 3456 7890", "FR76 3000 6000 0112 3456 7890"),
    ("iban", "serial XQ12ABCDEFGHABCD was returned", None),
    ("iban", "model ZZ34HGFEDCBAHGFE is new", None),
    ("account", "Customer 40817 is out, bank account 408178103099 is not", "408178103099"),
    ("account", "Deposit it into account 7300 1234 5678 9013 now", "7300 1234 5678 9013"),
    ("account", "My account number: 9182736455", "9182736455"),
    ("account", "the order 408178103099 has shipped", None),
    ("account", "barcode 4006381333931 on the box", None),
    ("account", "build 20240131123000 failed", None),
    ("account", "it sold 000000000000 times", None),
    ("passport", "She showed passport no. X1234567 at the desk", "X1234567"),
    ("passport", "travel document C01X is void, passport CF1234567 is not", "CF1234567"),
    ("passport", "identity card L9876543 expired", "L9876543"),
    ("passport", "flight A1234567 was late", None),
    ("passport", "part B7654321 fits", None),
    ("passport", "the model X1234567 costs more", None),
    ("birth_date", "He was born on 12.03.1980 in Rome", "12.03.1980"),
    ("birth_date", "date of birth: 1975-11-30", "1975-11-30"),
    ("birth_date", "DOB 4/7/1991, male", "4/7/1991"),
    ("birth_date", "version 12.03.2019 is out", None),
    ("birth_date", "released 2021-11-30 for all", None),
    ("birth_date", "the meeting 4/7/2022 was short", None),
    ("name", "The letter was signed by Dr. Helen Brandt.", "Dr. Helen Brandt"),
    ("name", "ask Mr. Okafor about it", "Mr. Okafor"),
    ("name", "Frau Schneider kommt morgen", "Frau Schneider"),
    ("name", "we met Mrs. Alvarez and left", "Mrs. Alvarez"),
    ("name", "Mr. Speaker, I rise again", None),
    ("name", "thank you, Mr. President", None),
    ("name", "looking for Mr. Right", None),
    ("address", "She lives at 42 Maple Street with her dog", "42 Maple Street"),
    ("address", "Deliver to 1600 North Elm Avenue please", "1600 North Elm Avenue"),
    ("address", "address: 7 Kings Road", "7 Kings Road"),
    ("address", "chapter 12 Sesame Street is fun", None),
    ("address", "episode 3 Wall Street opens", None),
]
ADDED = pii.NAMES[len(pii.RULES) :]


def found(spark, texts):
    rows = pii.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {r.doc_id: {tuple(s.split(":")) for s in r.spans.split(",") if s} for r in rows}


def test_hand_labelled_sentences(spark):
    got = found(spark, [t for _, t, _ in LABELLED])
    right, said, real = Counter(), Counter(), Counter()
    for i, (kind, text, span) in enumerate(LABELLED):
        spans = {text[int(a) : int(b)] for k, a, b in got[i] if k in ADDED}
        real[kind] += span is not None
        said[kind] += len(spans)
        right[kind] += span in spans
    table = {k: (right[k], said[k], real[k]) for k in ADDED}
    assert set(real) == set(ADDED)
    assert all(r >= 0.8 * s for r, s, _ in table.values()), table  # precision
    assert all(r >= 0.66 * n for r, _, n in table.values()), table  # recall
    assert sum(right.values()) >= 0.9 * sum(real.values()) and sum(right.values()) >= 0.95 * sum(said.values()), table


def test_bare_long_numbers_are_decided_by_the_trees(spark):
    got = found(spark, ["ere thion 980791576280449 onerin", "ere thion 4539578763621486 onerin", "see 20240131123000 there"])
    assert {k for k, *_ in got[0]} == {"account"} and {k for k, *_ in got[1]} == {"card"} and not got[2]


def test_long_runs_end(spark):
    n = 1_000_000
    texts = ["1" * n, "1 " * (n // 2), "1 23-4 " * (n // 7), "a@b" + ".c" * (n // 2), "a" * n, "ab (at) cd" + " (dot) cd" * (n // 9), "." * n, "+1" + "." * n, "+1" + ".2" * (n // 2), "1." * (n // 2), "A" * n, "AB12" + "CD34" * (n // 4), "Mr " * (n // 3), "123 456 7890 " * (n // 13), "(dot)" * (n // 5), "12/" * (n // 3), "1 Ab " * (n // 5)]
    got = found(spark, texts)
    assert got[3] == {("email", "0", str(len(texts[3])))} and len(got) == len(texts)
    assert {k for k, *_ in got[9]} == {"ip"} and len(got[9]) == n // 2 // 4


def test_redaction_by_row(spark):
    table = spark.createDataFrame([(None, "mail a@b.com", "f"), (None, "clean", "f"), (1, "call me: 415-555-2671 or +1 (415) 555-2671", "f"), (1, "call me: 415-555-2671 or +1 (415) 555-2671", "f"), (1, "x", "f"), (2, None, "f")], "doc_id long, text string, found string")
    table = table.withColumns({"key": table.found, "spans": table.found, "row": table.found})
    rows = pii.redact(table).collect()
    assert rows[0].asDict().keys() == dict.fromkeys(table.columns).keys()
    assert sorted((str(r.doc_id), str(r.text)) for r in rows) == sorted([("None", "mail [PII]"), ("None", "clean"), ("1", "call me: [PII] or [PII]"), ("1", "call me: [PII] or [PII]"), ("1", "x"), ("2", "None")])
    assert pii.redact(table.limit(0)).count() == 0


def test_thresholds_and_marks():
    assert pii.threshold([(0.9, 1.0), (0.8, 1.0), (0.7, 0.0), (0.6, 1.0)], 0.98) == 0.8
    assert pii.threshold([(0.9, 0.0)], 0.98) == 1.0 and pii.threshold([(0.4, 1.0)], 0.98) == 1.0
    assert S.MARK != S.INNER
