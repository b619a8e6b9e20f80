"""Fixed kinds against plain loops; bootstrapped contexts on a small corpus."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from rasterloom.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a@b.c", "a@b@c.d", "x.y@z.com_q@r.st a@b. c@d..e", "1.2.3.4.5.6.7.8 256.1.1.1 0255.00.1.1 1.1.1",
    "4111 1111 1111 1111 x 4111-1111-1111-1111", "+1 (743) 555-3824 +1(2) +12 345 678 901 234 567 ( ", "1" * 50_000,
    "a" * 50_000 + "@b.co", "@" * 500, "+1" + " " * 50_000, "é" * 50 + " a@b.co \U0001f600 1.2.3.4", "1 " * 9000,
    "." * 900 + "@" + "." * 900, "", None, "4485 2757 4230 8327 4485275742308327", "٣٤٥@x.com １２.3.4.5", "1.1.1.1" * 900,
    "4111\t111111111111 4111 1111 1111 1111",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            value, digits = m.group(), re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in value.split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_fixed_kinds_equal_loops(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "q@r.st"), (0, "a@b.c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "key", "t", "kind", "start")})
    got = pii.find(docs).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        want = base_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert r.spans.startswith(",".join(want))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in PLAIN]
    assert pii.find(docs.where("false")).collect() == []


def test_contexts_find_unseen_identifiers(spark):
    known = [f"please reach account holder user{i}@mail.org today" for i in range(12)]
    unseen = ["please reach account holder AC-7741-09 today", "in the year 1984 it rained"]
    noise = [f"in the year {1900 + i} it was dry" for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(known + unseen + noise)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    start = unseen[0].index("AC-")
    assert got[12].spans == f"context:{start}:{start + 10}" and got[12].n_context == 1
    assert all(got[i].spans == "" for i in range(13, 26))
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[12] == "please reach account holder <CONTEXT> today" and clean[0] == "please reach account holder <EMAIL> today"


def test_contexts_go_on_until_a_round_finds_none(spark):
    places = ["red alpha", "blue beta", "pink gamma", "gray delta"]
    chain = [[f"u{i}@mail.org" for i in range(40)], *([f"{c}-{1000 + i}" for i in range(n)] for c, n in zip("pqrs", (20, 10, 4, 1), strict=True))]
    texts = [f"{places[k]} {v} ok" for k in range(4) for v in chain[k] + chain[k + 1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.occurrences(docs)
    assert {r.value for r in pii.bootstrap(found).collect()} == {v for part in chain[1:] for v in part}
    with pytest.raises(RuntimeError):
        pii.bootstrap(found, rounds=2)


def test_identifiers_in_groups(spark):
    known = [f"please reach account holder user{i}@mail.org today" for i in range(12)]
    unseen = ["please reach account holder 1234 5678 9012 today", "please reach account holder AC-77 123-4 9.", "account holder 1234 2nd"]
    apart = ["account holder 1.2.3.4 5678 x", "account holder 12345 1.2.3.4 x", "holder a@b.c1 5678 9 x", "account holder 12345 77@b.c"]
    docs = spark.createDataFrame(list(enumerate(known + unseen + apart)), "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert [clean[i] for i in (12, 13, 14)] == ["please reach account holder <CONTEXT> today", "please reach account holder <CONTEXT>.", "account holder <CONTEXT> 2nd"]
    assert [clean[i] for i in (16, 18)] == ["account holder <CONTEXT> <IP> x", "account holder <CONTEXT> <EMAIL>"]
    found = {(r.id, r.value) for r in pii.occurrences(docs).where("kind = 5").collect() if r.id > 14}
    assert found == {(15, "5678"), (16, "12345"), (17, "5678 9"), (18, "12345")}


def test_redaction_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "x 1.2.3.4 y a@b.c", 7), (2, None, 8), (3, "plain", 9)], "doc_id long, text string, __cut_no int")
    rows = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert rows[1].text == "x <IP> y <EMAIL>" and rows[2].text is None and rows[3].text == "plain" and rows[3]["__cut_no"] == 9


def test_context_words_of_any_length_and_other_identifiers(spark):
    """The two words before a value are whole, however long, and ``digits`` says what a candidate is."""
    lead = "w" * 300
    rows = [(i, f"{lead} number{'.' * 150} a{i}@b.co") for i in range(5)] + [(9, f"then {lead} number{'.' * 150} zz4711")]
    rows += [(10, f"then other number{'.' * 150} zz4712"), (11, f"and {lead} number{'.' * 150} q7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = {r.value: r.before for r in pii.occurrences(docs).where("kind > 0").collect()}
    assert before["zz4711"].split() == [lead, "number" + "." * 150] and before["zz4712"].split()[0] == "other" and "q7" not in before
    assert all(len(pii.occurrences(docs, digits=n).where("value = 'q7'").collect()) == (n == 1) for n in (1, 2))
    assert {r.doc_id: r.n_context for r in pii.find(docs).collect() if r.n_context} == {9: 1, 10: 1}
    assert "<CONTEXT>" in pii.redact(docs, digits=1).where("doc_id = 11").first().text
    odd = spark.createDataFrame([(1, None), (2, "x a@b.co"), (2, "x a@b.co"), (None, "c@d.ef")], "doc_id long, text string")
    assert sorted(str(r.text) for r in pii.redact(odd).collect()) == ["<EMAIL>", "None", "x <EMAIL>", "x <EMAIL>"]
    assert pii.redact(odd.where("false")).collect() == []
