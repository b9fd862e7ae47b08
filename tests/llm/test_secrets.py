"""Secrets: spans against plain regular expressions, and queries of trigrams against matches."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.llm import secrets
from tradewind.llm.queries import queries
from tradewind.llm.trigrams import grams_of, trigram_query

FOLDER = "/root/testdata/sf0.01"

SECRETS = [
    'x Password = "abc123" y', "API_KEY:zzzzzz", "apikey='abcdef'", "token=short", "token = secret: passwd=aaaaaaaaa", "AKIA" + "Q" * 16, "AKIA" + "Q" * 15,
    "f" * 24, "g" + "0a" * 30 + "g", "ſecret=abcdefgh", "toKen=abcdefgh", "-----BEGIN RSA PRIVATE KEY-----\nAAAA\nBBBB=\n-----END RSA PRIVATE KEY-----",
    "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM", "see https://me:pass@host/x", "Authorization: Bearer abcdefghijklmnopqrstuvwxyz", "ghp_" + "a1" * 20,
    "xoxb-1234567890-abc", "AIza" + "x" * 35, "sk_live_" + "a" * 20, "password\t=abcdefg", 'SECRET"  :  "a/b+c=._-"', "é" * 30 + "token:abcdefg",
]


def brute(text):
    text, found = text or "", []
    for k, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text, re.ASCII):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), k, m.end()))
    return [(secrets.RULES[k].kind, s, e) for s, k, e in sorted(found)]


def check(rows, texts):
    for r, text in zip(rows, texts, strict=True):
        want = brute(text)
        base = [x for x in want if x[0] in ("assign", "access", "hex")]
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[0] == k for x in base) for k in ("assign", "access", "hex")]


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    out = queries()["op6_secret_scan"](spark, FOLDER).collect()
    assert len(out) == len(docs) and any(r.spans for r in out)
    check(out, [docs[r.doc_id] for r in out])


def test_base_rules_are_the_contract():
    """The base patterns written out in full, letter by letter."""
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join(map(either, ("password", "passwd", "secret", "token"))) + "|" + either("api") + "_?" + either("key")
    assign = rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for text in [*SECRETS, " ".join(SECRETS), "\n".join(SECRETS[::-1])]:
        want = [("assign", m.start(), m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
        want += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert sorted(x for x in brute(text) if x[0] in ("assign", "access", "hex")) == sorted(want)


def test_odd_rows(spark, table, odd_pairs):
    pairs = [*odd_pairs, *((100 + i, t) for i, t in enumerate(SECRETS)), (200, "pad " * 400_000 + SECRETS[0])]
    out = secrets.with_secrets(table(pairs), ["doc_id"]).collect()
    assert len(out) == len(pairs)
    for r in out:
        assert [(s.kind, s.start, s.end) for s in r.spans] == brute(r.text)
    assert secrets.with_secrets(table([]), ["doc_id"]).count() == 0


def test_redaction(spark, table):
    df = secrets.with_secrets(table([*enumerate(SECRETS), (99, None), (98, "none"), (97, "é token=abcdefgh, " * 3)]), ["doc_id"])
    for r in df.withColumn("clean", secrets.redacted(F.col("text"), F.col("spans"))).collect():
        want, at = "", 0
        for kind, start, end in brute(r.text):
            if end > at:
                want += r.text[at:start] + f"[{kind}]" if start >= at else ""
                at = end
        assert r.clean == (None if r.text is None else want + r.text[at:])


def holds(query, text):
    if query is None:
        return True
    if isinstance(query, frozenset):
        return all(g in text for g in query)
    return (all if query[0] == "and" else any)(holds(q, text) for q in query[1])


PATTERNS = [r.pattern for r in secrets.RULES] + [
    "abc|abd", "(abc|x)def", "a[bc]d+e", "(?:ab){2,3}c", "x*abc?def", "ab.cd", "(abc)?def", "[^a]bcd", "a{3}", "(?i:ABCD)[0-9]", "abc$|^xyz", "",
]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_a_match_satisfies_the_query(pattern):
    query = trigram_query(pattern, re.ASCII)

    @settings(max_examples=40, deadline=None)
    @given(st.from_regex(re.compile(pattern, re.ASCII)))
    def matching(text):
        low = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode("utf-8", "surrogatepass"))
        assert holds(query, low)

    matching()


def test_queries_demand_what_they_can():
    assert trigram_query("abc|abd") == ("or", (frozenset([b"abc"]), frozenset([b"abd"])))
    assert trigram_query("abcd") == frozenset([b"abc", b"bcd"])
    assert trigram_query("abc|.") is None and trigram_query("[0-9a-f]{24,}") is None
    assert grams_of(trigram_query(secrets.RULES[1].pattern)) == {b"aki", b"kia"}
