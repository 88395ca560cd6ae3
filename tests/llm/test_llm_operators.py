"""Numbered operators against brute force, on small literal tables with nulls,
empty and long texts, ties, repeated rows and clashing column names."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash

from kestrel.llm import bpe, components, decontam, hmm, labelled, licenses, linededup, quality, rules, simhash, suffixes, toxicity
from kestrel.llm.queries import vocabulary_path

EDGE = [(None, "alpha beta gamma"), (1, None), (2, ""), (3, " \t\n "), (4, "alpha beta gamma"), (4, "alpha beta gamma"),
        (5, "word " * 30_000), (6, "Ünïcode 'tis \x00 日本語 \U0001F600\r\n\n end")]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def edge(spark):
    """Odd rows, with columns named like the operators' own."""
    rows = [(d, t, "x", 1, "k") for d, t in EDGE]
    return spark.createDataFrame(rows, SCHEMA + ", score string, n int, _key string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return (t or "").encode().lower().split()


def alnum_words(t):
    low = (t or "").translate({c: c + 32 for c in range(65, 91)})
    out, cur = [], ""
    for ch in low:
        if ch.isdigit() and ch < "\x80" or "a" <= ch <= "z" or ch >= "\x80":
            cur += ch
        else:
            out.append(cur)
            cur = ""
    return [w for w in out + [cur] if w]


# ---- 2: SimHash --------------------------------------------------------
def brute_fingerprint(t):
    w = words(t)
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def brute_classes(values, near):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("t", [t for _, t in EDGE if t is None or len(t) < 1000] + ["a", "A b", "a b c d"])
def test_fingerprint(t):
    assert simhash.fingerprint((t or "").encode()) == brute_fingerprint(t)


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(5)
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for _ in range(3000):
        diff = sum(1 << i for i in rng.sample(range(64), rng.randint(0, 2)))
        assert any(diff & m & (2 ** 64 - 1) == 0 for m in masks)


@pytest.mark.parametrize("pair_limit", [1, 4, 1000])
def test_links_give_the_components_of_all_pairs(spark, pair_limit):
    rng = random.Random(6)
    fps = set()
    for _ in range(12):  # groups around a centre, some chains
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            x = x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) if rng.random() < .5 else x ^ (1 << rng.randrange(6))
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    edges = simhash.links(df, 2, pair_limit)
    assert all((a ^ b).bit_count() <= 2 for a, b in ((r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in edges.collect()))
    root = {r.node & (2**64 - 1): r.root for r in components.connected_components(edges, "a", "b").collect()}
    got = [root.get(x, x) for x in fps]
    want = brute_classes(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_simhash_edge_rows(edge, empty):
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(edge).collect()}
    assert simhash.near_duplicates(edge).count() == len(EDGE)
    assert got[(1, "0" * 16)] == got[(2, "0" * 16)] == got[(3, "0" * 16)] == 1
    fp = "%016x" % brute_fingerprint("alpha beta gamma")
    assert got[(None, fp)] == got[(4, fp)] == 4
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6]
    assert simhash.keep_one(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(200, 201), (201, 200), (7, 7), (None, 3)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(80)}, 200: 200, 201: 200}


# ---- 3: line dedup -----------------------------------------------------
def brute_line_dedup(rows):
    """Chunks by the written rule, in plain Python."""
    def chunks(t):
        """(lines with the blank ones behind, bytes that are compared, non-blank lines) of each chunk."""
        lines = t.split("\n")
        at = [i for i, x in enumerate(lines) if x.encode().strip()]
        if len(lines) < 2 or len(at) < 2:
            return [(lines, "", 0)]
        h = [int(hashlib.md5(lines[i].encode()).hexdigest()[:15], 16) % linededup.PRIME for i in at]
        r = [linededup.PRIME + 1] + [(h[i] * linededup.FACTOR + h[i - 1]) % linededup.PRIME for i in range(1, len(h))]
        out, a = [], 0
        for i in range(len(at)):
            if i == len(at) - 1 or i > 0 and r[i] < r[i + 1] and r[i] <= r[i - 1]:
                start = at[a] if a else 0
                stop = at[i + 1] if i + 1 < len(at) else len(lines)
                out.append((lines[start:stop], "\n".join(lines[at[a]:at[i] + 1]), i + 1 - a))
                a = i + 1
        return out
    docs = sorted({(d, t) for d, t in rows if t is not None}, key=lambda x: (x[0] is not None, x))
    seen, result = set(), {}
    for d, t in docs:
        left = []
        for c, key, solid in chunks(t):
            if solid >= 2 and key in seen:
                continue
            if solid >= 2:
                seen.add(key)
            left += c
        result[(d, t)] = "\n".join(left)
    return result


def test_line_dedup(spark, empty):
    rng = random.Random(9)
    pool = [f"line {i} of the pool" for i in range(25)] + ["", "  "]
    blocks = [[rng.choice(pool) for _ in range(rng.randint(6, 14))] for _ in range(5)]
    rows = []
    for d in range(120):
        lines = []
        for _ in range(rng.randint(0, 4)):
            lines += rng.choice(blocks) if rng.random() < .6 else [f"own {d} {rng.random()}" for _ in range(rng.randint(1, 5))]
        rows.append((d, "\n".join(lines)))
    rows += [rows[3], (None, rows[4][1]), (500, None), (501, "\n\n\n"), (502, "\n\n\n"), (503, "one line"), (504, "one line")]
    out = linededup.dedup_lines(spark.createDataFrame([(d, t, 1) for d, t in rows], SCHEMA + ", pos int")).collect()
    want = brute_line_dedup(rows)
    assert len(out) == len(rows) and out[0].__fields__[:3] == ["doc_id", "text", "pos"]
    assert sum(r._n_chunks for r in out) > 50
    for r in out:
        if r.doc_id == 500:
            assert r.text is None
    changed = Counter((r.doc_id, r.text) for r in out)
    assert changed == Counter((d, want[(d, t)] if t is not None else None) for d, t in rows)
    assert linededup.dedup_lines(empty).count() == 0


def test_line_chunks_resist_shifts(spark):
    rng = random.Random(10)
    lines = [f"text {rng.random()}" for _ in range(200)]
    got = {r.doc_id: r for r in linededup.dedup_lines(spark.createDataFrame(
        [(1, "\n".join(lines)), (2, "\n".join(["new first line"] + lines[:100] + ["inserted"] + lines[100:]))], SCHEMA)).collect()}
    assert got[1]._n_lines == 0 and got[2]._n_lines >= 180 and "inserted" in got[2].text


@pytest.mark.parametrize("between", ["\n", "\n\n", "\n \n\t\n"])
def test_blank_lines_hide_no_copy(spark, between):
    rng = random.Random(12)
    shared = [f"paragraph {rng.random()} of forty" for _ in range(40)]
    texts = {1: shared, 2: [f"own {rng.random()}" for _ in range(20)] + shared + [f"more {rng.random()}" for _ in range(20)], 3: shared}
    got = {r.doc_id: r.text.count("paragraph") for r in linededup.dedup_lines(
        spark.createDataFrame([(d, between.join(x)) for d, x in texts.items()], SCHEMA)).collect()}
    assert got[1] == 40 and got[2] <= 5 and got[3] <= 1


CLASH = ["_n_chunks", "_n_lines", "_gone", "_here", "_id", "_text_hash", "_th", "_h", "row", "id", "th", "old", "new", "gone", "changed", "root", "k"]


def test_names_of_the_input_meet_no_internal_ones(spark):
    cols = "doc_id long, text string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)
    text = "\n".join(f"line {i} of a text" for i in range(30))
    rows = [(i, text if i < 3 else f"other words {i}\nand {i} more", 7, *[f"{c} {i}" for c in CLASH]) for i in range(6)]
    df = spark.createDataFrame(rows, cols)
    plain = {r.doc_id: r for r in linededup.dedup_lines(df.select("doc_id", "text")).collect()}
    for r in linededup.dedup_lines(df).collect():
        assert (r.text, r._n_chunks, r._n_lines) == tuple(plain[r.doc_id]["text _n_chunks _n_lines".split()[k]] for k in range(3))
        assert all(r[c] == f"{c} {r.doc_id}" for c in CLASH[2:])
    bare = linededup.dedup_lines(df, counts=False, length="n_chars")
    assert bare.columns == df.columns
    for r in bare.collect():
        assert r.n_chars == (len(r.text) if plain[r.doc_id]._n_chunks else 7) and r._n_chunks == f"_n_chunks {r.doc_id}"
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(kept.collect()) == sorted(r for r in df.collect() if r.doc_id not in (1, 2))
    twice = df.where("doc_id = 5").unionByName(df.where("doc_id = 5").withColumn("k", F.lit("z"))).unionByName(df.where("doc_id = 5"))
    assert simhash.keep_one(twice).count() == 1


# ---- 4: licences -------------------------------------------------------
def test_unknown_identifiers_and_other_tags(spark):
    rows = [(0, "SPDX-License-Identifier: OFL-1.1\n"), (1, "SPDX-License-Identifier: MIT AND EUPL-1.2"), (2, "license: 0BSD or MIT"),
            (3, "Licence: see the file"), (4, "SPDX-License-Identifier: LicenseRef-x WITH y-exception")]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: ("ofl-1.1", 0.0), 1: ("eupl-1.2,mit", 0.0), 2: ("0bsd,mit", 1.0), 3: ("", 0.0), 4: ("licenseref-x", 0.0)}
    other = licenses.scan(spark.createDataFrame([(0, "Copying: MIT")], SCHEMA), tags=["copying:"]).first()
    assert (other.labels, other.score) == ("mit", 1.0)


def test_licence_places(spark, edge, empty):
    rng = random.Random(2)
    voc = "gnu general public license apache mit cc by é GNU License x MIT-License CC cc-by , . \n".split(" ")
    rows = [(i, " ".join(rng.choice(voc) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect():
        w, starts, labels = alnum_words(rows[r.doc_id][1]), [], set()
        for p, label in licenses.BASE_PHRASES.items():
            q = p.split()
            at = [i for i in range(len(w) - len(q) + 1) if w[i:i + len(q)] == q]
            starts += at
            labels |= {label} if at else set()
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == \
            (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))
        assert labels <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    out = licenses.scan(edge).collect()
    assert len(out) == len(EDGE) and all(r.n_base == 0 and r.labels == "" and r.first_word is None for r in out)
    assert licenses.scan(empty).count() == 0


@pytest.mark.parametrize("text, labels, value", [
    ("MIT OR Apache-2.0", {"mit", "apache"}, 1.0), ("MIT AND GPL-3.0-only", {"mit", "gpl"}, 0.3),
    ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl"}, 0.65), ("GPL-2.0 OR MIT AND CC-BY-4.0", {"gpl", "mit", "cc-by"}, 0.8),
    ("(GPL-2.0 OR MIT) AND CC-BY-4.0 trailing words", {"gpl", "mit", "cc-by"}, 0.8), ("((MIT))", {"mit"}, 1.0),
    ("MIT AND (", {"mit"}, 1.0), ("AGPL-3.0", {"agpl"}, 0.2), ("LicenseRef-x OR BSD-3-Clause\nGPL", {"bsd"}, 1.0)])
def test_licence_expressions(text, labels, value):
    got = licenses.parse_expression(text.lower())
    assert got[0] == labels and math.isclose(got[1], value)


def test_no_licence_expression():
    assert licenses.parse_expression("and mit") is None
    assert licenses.parse_expression("foo or bar") is None
    assert licenses.parse_expression("(" * 5000 + "mit") is None
    assert licenses.parse_expression(" or ".join(["mit"] * 20_000)) == ({"mit"}, 1.0)


# ---- 6: repeated passages ----------------------------------------------
def brute_passages(rows, length):
    places, covered, late = defaultdict(set), defaultdict(set), defaultdict(set)
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - length + 1):
            places[tuple(w[i:i + length])].add((d, i))
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                covered[d] |= set(range(i, i + length))
                if (d, i) != min(found):
                    late[d] |= set(range(i, i + length))
    return covered, late


def test_repeated_passages(spark, edge, empty):
    rng = random.Random(3)
    voc = [f"w{i}" for i in range(40)]
    base = [[rng.choice(voc) for _ in range(40)] for _ in range(6)]
    rows = []
    for d in range(200):
        w = []
        for _ in range(rng.randint(0, 6)):
            b, a = rng.choice(base), rng.randint(0, 20)
            w += b[a:a + rng.randint(5, 30)] if rng.random() < .6 else [rng.choice(voc) for _ in range(rng.randint(1, 15))]
        rows.append((d, " ".join(w)))
    rows += rows[:5] + [(900, None), (901, "")]
    got = suffixes.repeated_passages(spark.createDataFrame(rows, SCHEMA), length=12, seed=4).collect()
    covered, late = brute_passages(rows, 12)
    assert {r.doc_id: {i for s in r.spans for i in range(s.start, s.end)} for r in got} == dict(covered)
    assert {r.doc_id: {i for s in r.removable for i in range(s.start, s.end)} for r in got if r.removable} == dict(late)
    one = suffixes.repeated_passages(edge).collect()
    assert [(r.doc_id, r.n_repeated) for r in one] == [(5, 30_000)]   # one text repeats itself
    assert suffixes.repeated_passages(empty).count() == 0


def test_passage_links_lose_no_pair(spark):
    rng = random.Random(5)
    voc = [f"w{i}" for i in range(40)]
    p1, p2 = ([rng.choice(voc) for _ in range(20)] for _ in range(2))
    base = [[rng.choice(voc) for _ in range(40)] for _ in range(6)]
    rows = [(0, " ".join(p1 + ["a"])), (1, " ".join(["b"] + p2)), (2, " ".join(p2 + ["c"] + p1))]
    for d in range(3, 120):
        w = []
        for _ in range(rng.randint(0, 6)):
            b, a = rng.choice(base), rng.randint(0, 20)
            w += b[a:a + rng.randint(5, 30)] if rng.random() < .6 else [rng.choice(voc) for _ in range(rng.randint(1, 15))]
        rows.append((d, " ".join(w)))
    n, text = 12, {d: t.split() for d, t in rows}
    places = defaultdict(set)
    for d, w in text.items():
        for i in range(len(w) - n + 1):
            places[tuple(w[i:i + n])].add((d, i))
    want = {(x, y) for at in places.values() for x, _ in at for y, _ in at if x < y}
    meet = defaultdict(set)
    for r in suffixes.repeated_passages(spark.createDataFrame(rows, SCHEMA), length=n, seed=4).collect():
        for s in r.links:
            assert text[r.doc_id][s.start:s.end] == text[s.first_doc][s.first_pos:s.first_pos + s.end - s.start]
            for i in range(s.end - s.start - n + 1):
                meet[s.first_doc, s.first_pos + i].add(r.doc_id)
    got = {(x, y) for docs in meet.values() for x in docs for y in docs if x < y}
    assert {(0, 2), (1, 2)} <= got and got == want


def merge_input(rows):
    import pyarrow as pa
    link = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("first_doc", pa.string()), ("first_key", pa.int64()), ("first_pos", pa.int32())])
    return pa.RecordBatch.from_pylist(rows, pa.schema([("_id", pa.string()), ("_key", pa.int64()), ("_first", pa.string()), *((c, pa.int32()) for c in ("s", "e", "rs", "re")),
                                                       ("links", pa.list_(link))]))


def test_passages_of_a_document_merge_across_batches(monkeypatch):
    monkeypatch.setattr(suffixes, "MERGE_ROWS", 3)
    rng, rows = random.Random(1), []
    for d in range(9):
        for _ in range(rng.randint(1, 12)):
            s = rng.randint(0, 60)
            links = [{"start": s, "end": s + rng.randint(1, 9), "first_doc": f"k{k}" if k else None, "first_key": k, "first_pos": s + rng.randint(0, 2)} for k in rng.choices(range(3), k=rng.randint(0, 4))]
            gone = (s, s + 2) if rng.random() < .5 else (None, None)
            rows.append({"_id": f"d{d}" if d else None, "_key": d, "_first": "a", "s": s, "e": s + rng.randint(1, 9), "rs": gone[0], "re": gone[1], "links": links})
    names = ["doc_id", "spans", "n_repeated", "removable", "n_removable", "first_doc", "links"]
    got = [r for b in suffixes.merged_batches([merge_input(rows[:7]), merge_input([]), merge_input(rows[7:])], names) for r in b.to_pylist()]
    assert [r["doc_id"] for r in got] == [None, *(f"d{d}" for d in range(1, 9))]

    def merged(pairs):
        out = []
        for s, e in sorted(pairs):
            if out and s <= out[-1][1]:
                out[-1][1] = max(out[-1][1], e)
            else:
                out.append([s, e])
        return out

    for d, r in enumerate(got):
        mine = [x for x in rows if x["_key"] == d]
        spans, gone = merged((x["s"], x["e"]) for x in mine), merged((x["rs"], x["re"]) for x in mine if x["rs"] is not None)
        assert [[x["start"], x["end"]] for x in r["spans"]] == spans and r["n_repeated"] == sum(e - s for s, e in spans)
        assert [[x["start"], x["end"]] for x in r["removable"]] == gone and r["n_removable"] == sum(e - s for s, e in gone)
        by = defaultdict(list)
        for x in (y for m in mine for y in m["links"]):
            by[x["first_key"], x["first_pos"] - x["start"]].append((x["start"], x["end"]))
        want = sorted((s, e, k, s + shift, f"k{k}" if k else None) for (k, shift), pairs in by.items() for s, e in merged(pairs))
        assert sorted((x["start"], x["end"], x["first_key"], x["first_pos"], x["first_doc"]) for x in r["links"]) == want
        assert [(x["start"], x["end"], x["first_key"], x["first_pos"]) for x in r["links"]] == [x[:4] for x in want]


def test_merging_passages_needs_memory_for_some_rows_only():
    import tracemalloc
    link = [{"start": i, "end": i + 50, "first_doc": "x", "first_key": i, "first_pos": 3} for i in range(30)]
    batch = merge_input([{"_id": "d", "_key": 5, "_first": "x", "s": i, "e": i + 50, "rs": None, "re": None, "links": link} for i in range(10_000)])
    tracemalloc.start()
    out = list(suffixes.merged_batches((batch for _ in range(4)), [f"c{i}" for i in range(7)]))   # 1.2 million links of one document
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 1 and len(out[0]["c6"][0]) == 30 and peak < 40e6


# ---- 7: language model -------------------------------------------------
def test_recursions_match_plain_baum_welch():
    rng = np.random.default_rng(0)
    n_sym, k = 7, 3
    m = hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(n_sym), k).T.copy())
    seqs = [rng.integers(0, n_sym, n) for n in (1, 2, 63, 64, 65, 128, 500, 3)]
    flat, size = np.concatenate(seqs), np.array([len(s) for s in seqs])
    ll = hmm.log_likelihood(flat, size, m)
    got = np.zeros(k), np.zeros((k, k)), np.zeros((k, n_sym))
    hmm.expected_counts(flat, size, m, *got)
    want = np.zeros(k), np.zeros((k, k)), np.zeros((k, n_sym))
    for s, value in zip(seqs, ll):
        a, c = np.zeros((len(s), k)), np.zeros(len(s))
        for t, o in enumerate(s):
            a[t] = (m.start if t == 0 else a[t - 1] @ m.move) * m.emit[o]
            c[t] = a[t].sum()
            a[t] /= c[t]
        assert math.isclose(np.log(c).sum(), value, rel_tol=1e-9, abs_tol=1e-9)
        b = np.ones((len(s), k))
        for t in range(len(s) - 2, -1, -1):
            b[t] = m.move @ (m.emit[s[t + 1]] * b[t + 1]) / c[t + 1]
            want[1][:] += np.outer(a[t], m.emit[s[t + 1]] * b[t + 1]) * m.move / c[t + 1]
        want[0][:] += a[0] * b[0]
        for t, o in enumerate(s):
            want[2][:, o] += a[t] * b[t]
    for x, y in zip(got, want):
        assert np.allclose(x, y)


def test_language_model_sums(spark, edge, empty):
    rng = random.Random(4)
    voc = [f"v{i}" for i in range(60)] + ["É", "x" * 50]
    rows = [(i, " ".join(rng.choice(voc[: 5 + i % 58]) for _ in range(rng.randint(0, 90)))) for i in range(150)]
    rows += [(None, "v1 v2"), (151, None), rows[7], rows[7]]
    got = hmm.score(spark.createDataFrame(rows, SCHEMA), top=10, warm_rows=20, warm_steps=2, steps=1).collect()
    train = [words(t) for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 7 != 2]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()) + len(train), len(c) + 1
    text = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        w = words(text[r.doc_id])
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(train) + 1) / (n + v + 1))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w) + 1, 1 + sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert hmm.score(edge, warm_steps=1, steps=1).count() == len(EDGE)
    assert hmm.score(empty, warm_steps=1, steps=1).count() == 0


def test_every_round_reads_all_training_texts(spark, monkeypatch):
    rows = [(i, " ".join(f"{'ab'[i % 2]}{(i * 7 + j * j) % 11}" for j in range(3 + i % 5))) for i in range(1_300)]
    seen, step = [], hmm.baum_welch_step

    def counted(part, *rest):
        got = step(part, *rest)
        seen.append((part.count(), got[1]))
        return got
    monkeypatch.setattr(hmm, "baum_welch_step", counted)
    hmm.score(spark.createDataFrame(rows, SCHEMA)).count()
    n_train = sum(zlib.crc32(str(d).encode()) % 7 != 2 for d, _ in rows)
    assert n_train > 1_000 and {n for n, _ in seen} == {n_train}
    gains = np.diff([x for _, x in seen])
    assert len(gains) > 2 and (gains[:-1] >= hmm.TOLERANCE).all() and gains[-1] < hmm.TOLERANCE


# ---- 8: byte-level BPE -------------------------------------------------
@pytest.fixture(scope="module")
def tik():
    import public_tokenizers
    import tiktoken
    ranks = bpe.load_ranks(bpe.read_vocabulary(vocabulary_path()))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, edge, empty, tik):
    rng = random.Random(1)
    parts = ["'", "s", "t", "re", "ve", "ll", "l", "e", "a", "B", "é", "1", "٣", " ", "  ", "\n", "\t", " ", "　", "!", "。", "日本", "😀", "'s", "\r\n", "Ⅷ"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(3000)] + [(3000, "a" * 5000)]
    df = spark.createDataFrame(rows, SCHEMA)
    enc = bpe.encode(df, vocabulary_path())
    for r in enc.collect():
        want = tik.encode_ordinary(rows[r.doc_id][1])
        assert r.ids == want
        assert r.offsets == [sum(len(tik.decode_single_token_bytes(i)) for i in want[:j]) for j in range(len(want))]
    assert {r.doc_id: bytes(r.data) for r in bpe.decode(enc, vocabulary_path()).collect()} == {d: t.encode() for d, t in rows}
    for r in bpe.round_trip(edge, vocabulary_path()).collect():
        t = dict(EDGE)[r.doc_id] or ""
        ids = tik.encode_ordinary(t)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                                                hashlib.sha256(t.encode()).hexdigest())
    assert bpe.round_trip(empty, vocabulary_path()).count() == 0


# ---- 9: rules ----------------------------------------------------------
def test_signals(spark, edge, empty):
    rng = random.Random(12)
    rows = [(i, "".join(rng.choice(["a ", "b ", "c", " ", "\n", "é", "#|", "x\ty ", " "]) for _ in range(rng.randint(0, 120)))) for i in range(300)]
    for r in rules.signals(spark.createDataFrame(rows, SCHEMA), stratum=None).collect():
        t = rows[r._id][1]
        w = [x.decode() for x in t.encode().split()]
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if x.encode().split()]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == \
            (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), len(lines) - len(set(lines)), len(covered))
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (6, None)], "doc_id long, quality int")
    out = rules.judge(edge, labels, stratum=None).collect()
    assert len(out) == len(EDGE) and all(r.base_failed and not r.kept for r in out)
    assert rules.judge(empty, labels, stratum=None).count() == 0


def test_binomial_tail(spark):
    from pyspark.sql import functions as F
    cases = [(x, n) for n in (1, 7, 400, 90_000) for x in (0, 1, 5, 300) if x <= n]
    df = spark.createDataFrame(cases, "x long, n long").select("x", "n", rules.binomial_tail(F.col("x"), F.col("n"), 0.01).alias("p"))
    for r in df.collect():
        terms = [math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(.01) + (r.n - i) * math.log(.99) for i in range(r.x + 1)]
        top = max(terms)
        exact = top + math.log(sum(math.exp(t - top) for t in terms))
        assert math.isclose(r.p, exact if r.x <= r.n * .01 else 0.0, rel_tol=1e-6, abs_tol=1e-6)


def test_cutoffs_limit_false_rejections(spark):
    from pyspark.sql import functions as F
    good = [(i, 0.002 if i % 500 else 0.2) for i in range(4000)]           # 8 good ones have many symbols
    bad = [(10_000 + i, 0.25) for i in range(500)]
    sig = spark.createDataFrame([(i, "s", v) for i, v in good + bad], "_id long, _stratum string, symbol_share double")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    grid = {"symbol_share": [0.5, 0.22, 0.1, 0.001]}
    pick = rules.cutoffs(sig, labels, rules=grid, alpha=0.01).collect()
    assert [(r.rule, r.cutoff, r.x, r.caught) for r in pick] == [("symbol_share", 0.22, 0, 500)]
    few = sig.where(F.col("_id") % 40 == 0)                                # 100 good documents certify nothing
    assert rules.cutoffs(few, labels, rules=grid, alpha=0.01).count() == 0


def test_joint_cutoffs_bind_and_keep_the_good(spark):
    """Rows that pass the base rule decide: one sequence per stratum over all rules."""
    plain = " ".join(f"word{i}" for i in range(60))
    marked = " ".join(f"word{i} ###" for i in range(60))                   # symbols: 180 of 490 + 180 characters
    loud = " ".join(f"WORD{i}" for i in range(60))
    docs = [(i, plain, "a") for i in range(300)] + [(1000 + i, marked, "a") for i in range(20)] + [(2000 + i, loud, "a") for i in range(20)]
    docs += [(3000 + i, "few words", "a") for i in range(50)]              # good by label, fail the base rule
    docs += [(5000 + i, plain, "b") for i in range(40)] + [(6000 + i, marked, "b") for i in range(20)] + [(7000, None, None)]
    labels = spark.createDataFrame([(d, 0 if 1000 <= d < 3000 or 6000 <= d < 7000 else 1) for d, _, _ in docs], "doc_id long, quality int")
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    gone = {r.doc_id for r in rules.judge(table, labels).where("not kept and not base_failed").collect()}
    assert gone == {d for d, _, _ in docs if 1000 <= d < 3000}             # b's 40 good documents certify nothing
    wide = rules.judge(table, labels, alpha=0.2).where("not kept and not base_failed and doc_id >= 5000")
    assert wide.count() == 20


def test_the_path_tightens_the_rules_in_turn(spark):
    grid = {"p": [3.0, 2.0, 1.0], "q": [9.0, 5.0]}
    order = rules.path(grid)
    assert order == [("p", 3.0), ("q", 9.0), ("p", 2.0), ("q", 5.0), ("p", 1.0)]
    rows = [(p / 2, float(q)) for p in range(9) for q in range(11)] + [(None, 6.0), (None, None)]
    for r in spark.createDataFrame(rows, "p double, q double").withColumn("k", rules.reached_step(grid)).collect():
        hit = [k for k, (n, c) in enumerate(order) if r[n] is not None and r[n] > c]
        assert r.k == (min(hit) if hit else None)


# ---- 10: decontamination -----------------------------------------------
def test_decontamination(spark, edge, empty):
    rng = random.Random(21)
    voc = [f"t{i}" for i in range(30)] + ["Ünï", "x1"]
    items = [(i, " ".join(rng.choice(voc) for _ in range(rng.randint(0, 25)))) for i in range(25)]
    items += [(25, "t1"), (26, None), (27, "!!"), (None, items[3][1]), items[4]]
    docs = []
    for d in range(200):
        w = [rng.choice(voc) for _ in range(rng.randint(0, 40))]
        if rng.random() < .4:
            t = (items[rng.randrange(25)][1] or "").split()
            a = rng.randint(0, max(len(t) - 10, 0))
            w[5:5] = t[a:a + rng.randint(8, 15)]
        docs.append((d, rng.choice([" ", ", ", "-"]).join(w).upper()))
    windows = defaultdict(set)
    for i, t in items:
        w = alnum_words(t)
        for a in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[a:a + 10])].add(i)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for words_in_block in (2_000_000, 40):
        got = decontam.contaminated_rows(decontam.hits(spark.createDataFrame(docs, SCHEMA), bench, block_words=words_in_block)).collect()
        assert len(got) == len(docs)
        for r in got:
            w, hit, names = alnum_words(docs[r.doc_id][1]), set(), set()
            for k, who in windows.items():
                for a in range(len(w) - len(k) + 1):
                    if tuple(w[a:a + len(k)]) == k:
                        hit |= set(range(a, a + len(k)))
                        names |= {str(x) for x in who if x is not None}
            assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(names), bool(hit))
            assert r.items_sha256 == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        kept = decontam.drop_contaminated(spark.createDataFrame(docs + docs[:9] + [(900, None)], SCHEMA), bench, block_words=words_in_block)
        bad = {r.doc_id for r in got if r.contaminated}
        assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs + docs[:9] + [(900, None)] if d not in bad)
        again = decontam.contaminated_rows(decontam.hits(edge, bench, block_words=words_in_block)).collect()
        assert len(again) == len(EDGE) and not any(r.contaminated for r in again)
        clean = decontam.drop_contaminated(edge, bench, block_words=words_in_block)
        assert clean.columns == edge.columns and clean.count() == len(EDGE)
    assert decontam.hits(empty, bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated_rows(decontam.hits(edge, none)).where("contaminated").count() == 0


# ---- 1 and 5: classifiers ----------------------------------------------
def labelled_docs(spark, n, kind):
    rng = random.Random(31)
    voc = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        w, y = [rng.choice(voc) for _ in range(rng.randint(20, 200))], int(rng.random() < .5)
        if kind == "quality" and not y:
            w = [x.upper() + "!!" for x in w] if rng.random() < .5 else [x for x in w[:8] for _ in range(12)]
        if kind == "toxic" and y:
            w[rng.randrange(len(w))] = rng.choice(["grimble", "grimbler", "grimbling", "zorkface", "zorkfaced"])
        if kind == "toxic" and rng.random() < .3:
            w[0] = rng.choice(["women", "men", "muslims", "jews"]) if y or rng.random() < .2 else w[0]
        docs.append((i, " ".join(w) + "."))
        labels.append((i, y))
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, f"doc_id long, {kind} int")


def accuracy(scored, labels, kind):
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    return sum(r.predicted == r[kind] for r in rows) / len(rows)


def test_quality_ranking(spark, edge, empty):
    docs, labels = labelled_docs(spark, 900, "quality")
    model = quality.fit(docs, labels)
    out = quality.scores(docs, model)
    assert accuracy(out, labels, "quality") > 0.97
    assert quality.keep_good(docs, model).count() == out.where("predicted = 1").count()
    rows = quality.scores(edge, model).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
    assert quality.scores(empty, model).count() == 0 and quality.fit(docs, labels.where("quality = 1")) is None
    assert {r.score for r in quality.scores(edge, None).collect()} == {0.5}


def test_quality_cutoff_is_the_best_quantile():
    s, good = np.array([0., 1, 1, 2, 3, 3, 4]), np.array([0, 0, 0, 0, 1, 1, 1], bool)
    assert 2 < quality.quantile_cutoff(s, good) < 3


def test_training_sample_leaves_out_the_fold_and_contradictions(spark):
    docs = spark.createDataFrame([(i, str(i)) for i in range(60)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(2, 1), (4, 0), (None, 1), (6, None)], "doc_id long, y int")
    got = sorted(int(r._text) for r in labelled.training_sample(docs, labels, "y").collect())
    assert got == [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1 and i != 2]
    assert labelled.training_sample(docs, labels, "y", per_class=3).count() == 6


def test_training_sample_has_one_row_per_id(spark):
    """An id on many rows sends one of them; the smallest id hashes are taken at any size."""
    docs = spark.createDataFrame([(5, f"copy {i}") for i in range(50)] + [(7, None), (7, None)] + [(i, str(i)) for i in range(100, 900)], SCHEMA)
    labels = spark.createDataFrame([(5, 1), (7, 0)] + [(i, i % 2) for i in range(100, 900)], "doc_id long, y int")
    rows = labelled.training_sample(docs, labels, "y").collect()
    assert len(rows) == len({r._lid for r in rows}) and {5, 7} & {i for i in (5, 7) if zlib.crc32(str(i).encode()) % 3 != 1} <= {r._lid for r in rows}
    few = {r._lid for r in labelled.training_sample(docs, labels, "y", per_class=40).collect()}
    ranked = labels.where(~labelled.held_out("doc_id")).select("doc_id", "y", F.xxhash64("doc_id").alias("h")).collect()
    assert few == {r.doc_id for c in (0, 1) for r in sorted((r for r in ranked if r.y == c), key=lambda r: r.h)[:40]}


def test_toxicity_and_identity_swaps(spark, edge, empty):
    docs, labels = labelled_docs(spark, 900, "toxic")
    free, tied = (toxicity.fit(docs, labels, penalty=p) for p in (0.0, 20.0))
    assert accuracy(toxicity.scores(docs, tied), labels, "toxic") > 0.95
    probes = spark.createDataFrame([(0, "people came here"), (1, "women came here"), (2, "muslims came here"), (3, "believers came here")], SCHEMA)

    def gap(m):
        s = {r.doc_id: r.score for r in toxicity.scores(probes, m).collect()}
        return abs(s[1] - s[0]) + abs(s[2] - s[3])
    assert gap(tied) < 0.05 and gap(tied) <= gap(free)
    rows = toxicity.scores(edge, tied).collect()
    assert len(rows) == len(EDGE) and all(r.predicted == 0 for r in rows)
    assert toxicity.scores(empty, tied).count() == 0 and toxicity.fit(docs, labels.where("toxic = 1")) is None
