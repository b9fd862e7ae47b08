"""Repeated passages that were planted by hand, and paragraphs against all pairs in full."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tradewind.llm import crowds, minhash, packed, paragraphs, sets, stars, stretches
from tradewind.llm.queries import queries
from tradewind.llm.text import power_tables, text_blocks
from tradewind.session import scratch_root

from .conftest import SMALL, prose
from .test_minhash import shingles


def pieces(text):
    """The paragraphs of a text as (words, text)."""
    for _, _, data, offsets in text_blocks(pa.array([text])):
        _, start, stop, _, starts, ends = paragraphs.cut(data, offsets, power_tables(max(1, len(data))))
        return [(int(b - a), data[starts[a] : ends[b - 1]].tobytes().decode()) for a, b in zip(start, stop, strict=True)]


def test_cuts_depend_on_the_words_around_them():
    passage = prose(3, 120)
    inside = [t for _, t in pieces(passage)][1:-1]
    assert len(inside) >= 3
    for before in (prose(8, 17), prose(9, 33) + "\n" + prose(10, 5)):
        found = [t for _, t in pieces(before + " " + passage + " " + prose(11, 40))]
        assert set(inside) <= set(found)
    assert pieces("a b\n\n c\td \n") == [(2, "a b"), (2, "c\td")]
    assert " ".join(t for _, t in pieces(passage)) == passage


def test_nearly_all_passages_of_over_fifty_words_hold_whole_paragraphs():
    """What lies wholly inside a passage is found; of 51 to 60 words about one in twenty has too little."""
    enough = {True: [], False: []}
    pick = random.Random(2)
    for k in range(300):
        size = pick.randint(51, 120)
        passage = prose(10_000 + k, size, 40_000)
        parts = pieces(prose(77 + k, 60, 40_000) + " " + passage + " " + prose(99 + k, 60, 40_000))
        inside = sum(n for n, t in parts if t in passage and n >= paragraphs.LEAST_WORDS)
        enough[size > 60].append(inside >= paragraphs.LEAST_SPAN)
    assert np.mean(enough[False]) >= 0.93 and np.mean(enough[True]) >= 0.995


def test_query_finds_the_pairs_of_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    units = [(r.doc_id, k, shingles(t)) for r in docs.collect() for k, (n, t) in enumerate(pieces(r.text)) if n >= paragraphs.LEAST_WORDS]
    linked = set()
    by_shingle = {}
    for u, (_, _, s) in enumerate(units):
        for x in s:
            by_shingle.setdefault(x, []).append(u)
    for us in by_shingle.values():
        for i, u in enumerate(us):
            for w in us[:i]:
                a, b = units[u][2], units[w][2]
                if 100 * len(a & b) >= 80 * len(a | b):
                    linked.add((units[u][0], units[u][1]))
                    linked.add((units[w][0], units[w][1]))
    found = paragraphs.repeated_paragraphs(docs).where("group is not null")
    many = {r["group"] for r in found.groupBy("group").count().where("count > 1").collect()}
    got = {(r.doc_id, r.paragraph) for r in found.collect() if r["group"] in many}
    assert got <= linked and len(got) >= 0.99 * len(linked)
    assert queries()["op2_paragraph_dedup"](spark, SMALL).columns == ["doc_id", "start", "end", "n_words", "kept_doc_id"]


def test_planted_passages_and_clean_texts(table):
    pick = random.Random(2)
    passages = [prose(10_000 + k, pick.randint(61, 120), 40_000) for k in range(20)]
    pairs, planted = [], {}
    for k, passage in enumerate(passages):
        for copy in range(4):
            doc = 10 * k + copy
            pairs.append((doc, prose(500 + doc, pick.randint(20, 90), 40_000) + " " + passage + " " + prose(800 + doc, 50, 40_000)))
            planted[doc] = (passage, 10 * k)
    pairs += [(1000 + k, prose(5000 + k, 150, 40_000) + "\nAll rights reserved to the same old house.") for k in range(50)]
    docs = table(pairs)
    texts = dict(pairs)
    found = paragraphs.repeated_spans(docs)
    out = found.collect()
    assert {r.doc_id for r in out} == {d for d in planted if d % 10}
    for r in out:
        passage, kept = planted[r.doc_id]
        cut = texts[r.doc_id][r.start : r.end]
        # A paragraph at the edge may be alike with some other words in it, up to a fifth.
        known = set(passage.split())
        assert sum(w in known for w in cut.split()) >= 0.8 * len(cut.split())
        assert r.kept_doc_id == kept and r.n_words <= len(cut.split())
    rest = {r.doc_id: r.text for r in paragraphs.without_spans(docs, found).collect()}
    for doc, text in texts.items():
        for r in sorted((r for r in out if r.doc_id == doc), key=lambda r: -r.start):
            text = text[: r.start] + text[r.end :]
        assert rest[doc] == text


def test_odd_rows(table, odd_pairs):
    docs = table(odd_pairs)
    out = paragraphs.repeated_spans(docs).collect()
    # The null ids come first, so theirs are the copies that stay; equal rows are one text.
    assert {(r.doc_id, r.kept_doc_id) for r in out} == {(1, None), (2, None), (8, None), (12, 8)}
    again = paragraphs.without_spans(docs, paragraphs.repeated_spans(docs))
    assert again.columns == docs.columns and again.count() == len(odd_pairs)
    assert paragraphs.repeated_spans(table([])).count() == 0


def test_bands_are_tuned():
    bands = paragraphs.tuned_bands(80, 2, 0.98)
    assert 1 - (1 - 0.64) ** bands >= 0.98 > 1 - (1 - 0.64) ** (bands - 1)
    assert np.isclose(paragraphs.RECALL, 0.98)


def removed(table, texts):
    out = {d: set() for d, _ in texts}
    for r in paragraphs.repeated_spans(table(texts)).collect():
        out[r.doc_id] |= set(range(len(dict(texts)[r.doc_id][: r.start].split()), len(dict(texts)[r.doc_id][: r.end].split())))
    return out


def test_passages_of_51_words_are_removed_whole(table):
    texts, places = [], {}
    for k in range(150):
        passage = prose(20_000 + k, 51 + k % 10, 40_000)
        for copy in range(2):
            head = prose(30_000 + 2 * k + copy, 40 + 7 * copy, 40_000)
            texts.append((2 * k + copy, head + " " + passage + " " + prose(40_000 + 2 * k + copy, 45, 40_000)))
        places[2 * k + 1] = range(47, 47 + 51 + k % 10)
    out = removed(table, texts)
    assert all(not out[2 * k] for k in range(150))
    assert all(set(places[d]) <= out[d] for d in places)
    # Hardly anything else goes: a paragraph at the edge may be alike though a word differs.
    assert sum(len(out[d]) for d in places) <= 1.02 * sum(len(p) for p in places.values())


def test_copies_that_overlap_keep_the_first(table):
    out = removed(table, [(1, "word " * 300), (2, prose(1, 30) + " " + "word " * 100)])
    assert 0 < len(out[1]) <= 300 - paragraphs.SEED and out[2] >= set(range(30, 130))


def wrapped(text, n):
    words = text.split()
    return "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))


def test_line_ends_do_not_hide_a_passage(table):
    """Verse, and copies that are wrapped at other columns, as paragraphs and as spans."""
    texts, clean = [], [(900 + k, wrapped(prose(70_000 + k, 200, 40_000), 3 + k)) for k in range(10)]
    for k in range(12):
        passage = prose(50_000 + k, 90, 40_000)
        for copy, n in enumerate([(5, 5), (7, 12), (3, 10)][k % 3]):
            head = prose(60_000 + 2 * k + copy, 30, 40_000)
            texts.append((2 * k + copy, head + "\n" + wrapped(passage, n) + "\n" + prose(61_000 + 2 * k + copy, 30, 40_000)))
    found = paragraphs.repeated_paragraphs(table(texts + clean), across=True).where("group is not null").collect()
    groups = {}
    for r in found:
        groups.setdefault(r["group"], set()).add(r.doc_id)
    covered = {d: set() for d, _ in texts}
    for r in found:
        if len(groups[r["group"]]) > 1:
            covered[r.doc_id] |= set(range(r.first, r.first + r.n_words))
    for k in range(12):
        assert len(covered[2 * k + 1] & set(range(30, 120))) >= 45
    out = removed(table, texts + clean)
    assert all(set(range(30, 120)) <= out[2 * k + 1] and not out[2 * k] for k in range(12))
    assert not any(out[d] for d, _ in clean)


def test_marks_reject_no_linked_pair():
    """Pairs of a bucket against all pairs, over the edges of batches, and marks against the sets."""
    pick = random.Random(5)
    texts = []
    for k in range(150):
        words = prose(80_000 + k, pick.randint(8, 40), 300).split()
        other = list(words)
        other[pick.choice([0, -1, pick.randrange(len(words))])] = "changed"
        texts += [" ".join(words), " ".join(other), " ".join(words[:-1]), " ".join(words + words[:6])]
    marks = []
    for _, _, data, offsets in text_blocks(pa.array(texts)):
        starts, _, rows = paragraphs.word_spans(data, offsets)
        words, _ = paragraphs.word_hashes(data, offsets, power_tables(len(data)))
        marks.append(paragraphs.set_marks(words, rows[:-1], rows[1:], paragraphs.SHINGLE_WORDS))
    marks, sets = np.concatenate(marks), [shingles(t) for t in texts]
    seen = {True: 0, False: 0}
    for i in range(len(texts)):
        near = paragraphs.may_be_linked(marks[i], marks, 80)
        for j in range(len(texts)):
            linked = 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
            assert near[j] or not linked
            seen[linked] += bool(near[j])
    assert seen[True] > len(texts) and seen[False] < seen[True]

    sizes = np.array([1, 2, 3, 128, 129, 1, 300, 5, 2])
    bucket, v = np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum())
    large = np.repeat(sizes > paragraphs.BUCKET_ROWS, sizes)
    expected = {(i, j) for i in v for j in v[i + 1 :][bucket[i + 1 :] == bucket[i]] if not large[i]}
    for step in (1, 50, 129, 1000):
        parts = [pa.RecordBatch.from_arrays([pa.array(x[i : i + step]) for x in (bucket, v, v * 0 + 5)], names=["bucket", "v", "marks"]) for i in range(0, len(v), step)]
        out = [p for r in paragraphs._meeting(iter(parts), 80) for p in zip(*(r.column(c).to_pylist() for c in ("a", "b")), strict=True)]
        assert {p for p in out if p[1] is not None} == expected
        assert sorted(a for a, b in out if b is None) == v[large].tolist()


def test_what_is_stored_stays_small(spark):
    """The steps of a search leave no more than twice the texts behind."""
    folder = Path("/root/testdata/sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    scratch = Path(scratch_root(spark).removeprefix("file:"))
    before = {p for p in scratch.rglob("*.parquet")}
    paragraphs.repeated_spans(docs)
    made = sum(p.stat().st_size for p in scratch.rglob("*.parquet") if p not in before)
    assert made <= 2 * size


def test_many_near_copies_of_a_paragraph(table):
    """More different near copies than a bucket compares in pairs are still one group."""

    def lines(k):
        return [f"{line} n{k}" for line in heads]

    whole = [t for t in (prose(7 + k, 12, 40_000) for k in range(50)) if all(len(pieces(f"{t} n{k}")) == 1 for k in range(300))]
    heads = whole[:2]
    count = paragraphs.BUCKET_ROWS + 70
    texts = [(k, "\n".join([prose(90_000 + k, 30, 40_000), *lines(k), prose(95_000 + k, 30, 40_000)])) for k in range(count)]
    out = removed(table, texts)
    assert not out[0] and all(out[k] >= set(range(30, 56)) for k in range(1, count))


def test_copies_that_end_with_their_text_keep_the_first(table):
    """The first copy goes on where later ones end; their longest common stretch is still found."""
    passage = prose(8, 60, 40_000)
    texts = [(1, prose(9, 40, 40_000) + " " + passage + " " + prose(10, 50, 40_000))]
    texts += [(k, prose(200 + k, 35, 40_000) + " " + passage) for k in range(2, 6)]
    out = removed(table, texts)
    found = paragraphs.repeated_spans(table(texts)).collect()
    assert not out[1] and all(out[k] >= set(range(35, 95)) for k in range(2, 6))
    assert {r.kept_doc_id for r in found} == {1}


def family(k, copies, words):
    """Texts that are alike but for two words each, at places of their own."""
    pick, base, out = random.Random(k), prose(110_000 + k, words, 40_000).split(), []
    for copy in range(copies):
        some = list(base)
        for at in (pick.randrange(words), pick.randrange(words)):
            some[at] = f"changed{copy}"
        out.append(" ".join(some))
    return out


def test_stretches_equal_brute_force(spark, table):
    """All 51 words that stand at an earlier place too are found, and nothing that doesn't."""
    texts = [t for k in range(6) for t in family(k, 9, 160)] + ["again and " * 60, prose(7, 25, 40_000) + " " + " ".join([prose(8, 37, 40_000)] * 9)]
    texts = list(enumerate(texts))
    found, numbers = stretches.repeated_stretches(paragraphs._keyed(table(texts)))
    covered = {d: set() for d, _ in texts}
    for r in found.join(numbers, "no").collect():
        covered[r.doc_id] |= set(range(r.first, r.last))
        assert texts[r.doc_id][1][r.start : r.end].split() == texts[r.doc_id][1].split()[r.first : r.last]
    places = {n: {} for n in (stretches.SEED, stretches.PASSAGE)}
    for n, known in places.items():
        for d, t in texts:
            words = t.split()
            for at in range(len(words) - n + 1):
                known.setdefault(tuple(words[at : at + n]), []).append((d, at))
    for (d, at), *rest in places[stretches.PASSAGE].values():
        assert all(set(range(i, i + stretches.PASSAGE)) <= covered[e] for e, i in rest if e != d or i >= at + stretches.PASSAGE)
    may = {d: set() for d, _ in texts}
    for _, *rest in places[stretches.SEED].values():
        for d, at in rest:
            may[d] |= set(range(at, at + stretches.SEED))
    assert all(covered[d] <= may[d] for d, _ in texts) and sum(map(len, covered.values())) > 4000


def test_ends_of_near_copies_take_little_room(spark, table, monkeypatch):
    """What is stored at once for copies that differ in a few words, against their texts."""
    texts = list(enumerate(t for k in range(30) for t in family(k, 15, 300)))
    scratch, sizes = Path(scratch_root(spark).removeprefix("file:")), []
    before = set(scratch.rglob("*.parquet"))

    def removed(spark, path, drop=paragraphs.removed):
        sizes.append(sum(p.stat().st_size for p in scratch.rglob("*.parquet") if p not in before))
        drop(spark, path)

    for module in (paragraphs, stretches):
        monkeypatch.setattr(module, "removed", removed)
    paragraphs.repeated_spans(table(texts))
    assert max(sizes) <= 1.5 * sum(len(t) for _, t in texts)


def test_texts_that_share_a_common_line_do_not_all_meet(table, monkeypatch):
    """Paragraphs over the end of a common line are alike but under the threshold: however many, no
    blocks of them are compared, and those that are near copies of each other are still found."""

    def called(*args):
        raise AssertionError("blocks of a bucket are compared")

    monkeypatch.setattr(minhash, "_joining", called)
    line = next(t for t in (prose(500 + k, 9, 40_000) for k in range(200)) if len(pieces(t)) == 1)
    own = [prose(120_000 + k, 2 + k % 3, 40_000) for k in range(9 * paragraphs.BUCKET_ROWS)]
    texts = [(k, f"{line}\n{words}") for k, words in enumerate(own)]
    pair = prose(130_000, 60, 40_000)
    texts += [(5000, f"{line}\n{pair}"), (5001, f"{line}\n{pair} more")]
    out = removed(table, texts)
    assert out[5001] >= set(range(9, 69)) and not out[0]


def shingle_numbers(k, size, common, families):
    """A set of whole numbers: common ones, those of a family, own ones."""
    pick = random.Random(k)
    own = {pick.getrandbits(64) for _ in range(pick.randint(0, size // 4))}
    family = random.Random(1_000_000 + k % families)
    return np.array(sorted(common | {family.getrandbits(64) for _ in range(size)} | own), np.uint64)


def test_rarest_shingles_bring_all_near_copies_together(spark):
    """Links among members of large buckets against all pairs; their components against a search."""
    pick = random.Random(9)
    common = {pick.getrandbits(64) for _ in range(12)}
    members = [shingle_numbers(k, 8 + k % 5, common, 80) for k in range(400)]
    parts, v = 5, np.arange(1, 401, dtype=np.int64) << 33
    sizes = np.array([len(m) for m in members])
    known = sets.dealt(packed.parts_of(v, parts), v, sizes, np.concatenate(members))
    crowd = packed.dealt(0, packed.parts_of(v, parts), {"v": v}).drop_columns("chunk")
    known, crowd = spark.createDataFrame(pa.Table.from_batches([known])), spark.createDataFrame(pa.Table.from_batches([crowd]))
    pairs, links = crowds.met(crowd, known, 80, parts)
    assert links.isEmpty()
    met = sum(len(r.a) // 8 for r in pairs.collect())
    found, _ = stars.stars(sets.linked(pairs, known, 80, parts), parts)
    got = {}
    for r in found.groupBy("part").applyInArrow(lambda t: pa.table(dict(zip(("v", "c"), stars.labels_of(t), strict=True))), "v long, c long").collect():
        got[r.v >> 33] = r.c >> 33
    above = list(range(401))

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    linked = 0
    for i in range(400):
        for j in range(i):
            both = len(np.intersect1d(members[i], members[j]))
            if 100 * both >= 80 * (sizes[i] + sizes[j] - both):
                linked += 1
                x, y = sorted((top(i + 1), top(j + 1)))
                above[y] = x
    assert linked > 200 and met < 400 * 399 / 8
    assert all(got.get(x, x) == top(x) for x in range(1, 401))


def test_stars_reach_the_ends_of_long_chains(spark):
    """Chains, stars, loops and repeated edges of any order."""
    pick = random.Random(4)
    edges = [(k, k + 1) for k in range(1, 300)] + [(1000, k) for k in range(1001, 1400)] + [(2000, 2000), (3001, 3000), (3000, 3001), (-5, -4), (-4, 7000)]
    name = {x: pick.getrandbits(62) - 2**61 for x in sorted({x for e in edges for x in e})}
    pick.shuffle(edges)
    rows = spark.createDataFrame([(name[a], name[b]) for a, b in edges], "a long, b long")
    links = rows.repartition(3).mapInArrow(lambda batches: stars.from_rows(batches, 4), stars.EDGES)
    found, _ = stars.stars(links, 4)
    got = found.groupBy("part").applyInArrow(lambda t: pa.table(dict(zip(("v", "c"), stars.labels_of(t), strict=True))), "v long, c long")
    got = {r.v: r.c for r in got.collect()}
    for group in (range(1, 301), range(1000, 1400), (3000, 3001), (-5, -4, 7000)):
        least = min(name[x] for x in group)
        assert all(got[name[x]] == least for x in group)
    assert got.get(name[2000], name[2000]) == name[2000]
