"""Operators 11 to 13 against the libraries and brute force: odd rows, whole small
tables, long conversations over many partitions."""

import hashlib
import heapq
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from kestrel.llm import bpe, conversations, crosstok, pairmerge, pieces
from kestrel.llm.queries import QUERIES, vocabulary_path
from kestrel.llm.textkit import column_bytes

SF = "/root/testdata/sf0.001"
PIECES, BYTES = vocabulary_path("piece_bpe_32k.model"), vocabulary_path("byte_bpe_50k.json")
PARTS = ["'", "s", "the", " the", "ve", "ll", "l", "e", "a", "B", "é", "1", "٣", " ", "  ", "\n", "\t", " ", "　", "!", "。",
         "日本", "😀", "\r\n", "Ⅷ", "▁", "▁▁", "\x00", "<s>", "<|endoftext|>", "ﬁ", "①", "é", "Å", "한", "ｶﾞ", "​", "﻿"]
ODD = [None, "", " ", "  ", " \t\n ", "a" * 3000, "▁" * 200, "日本語" * 500, "word " * 5000]
SCHEMA = "doc_id long, text string"


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ODD + ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def sha(b):
    return hashlib.sha256(b).hexdigest()


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def byte_library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def docs(spark):
    """Odd rows, repeated rows, a null id, and columns named like the operators' own."""
    rows = [(i, t, "x", 1, 2, "k") for i, t in enumerate(odd_texts(300))] + [(7, "the the", "x", 1, 2, "k")] * 2 + [(None, "the", "x", 1, 2, "k")]
    return spark.createDataFrame(rows, SCHEMA + ", row string, id int, n int, code string")


# ---- pair merging ------------------------------------------------------
def test_grid_and_heap_merge_alike():
    rng = random.Random(4)
    pairs = {(a, b): (rng.randrange(30), rng.randrange(8)) for a in range(8) for b in range(8) if rng.random() < .6}
    table = pairmerge.PairTable(*zip(*[(a, b, r, m) for (a, b), (r, m) in pairs.items()]))

    def slow(s):
        while True:
            best = min(((pairs[p][0], i) for i, p in enumerate(zip(s, s[1:])) if p in pairs), default=None)
            if best is None:
                return s
            i = best[1]
            s = s[:i] + [pairs[s[i], s[i + 1]][1]] + s[i + 2:]
    rows = [[rng.randrange(8) for _ in range(rng.choice([0, 1, 2, 3, 7, 16, 33, 64, 65, 90]))] for _ in range(400)]
    flat, sizes = pairmerge.merge_all(table, np.array(sum(rows, []), np.int32), np.array([len(r) for r in rows]))
    upto = np.concatenate([[0], np.cumsum(sizes)])
    for r, a, b in zip(rows, upto, upto[1:]):
        assert flat[a:b].tolist() == slow(r)
        assert pairmerge._merge_long(table, list(r)) == slow(r)


def test_json_vocabulary_equals_the_library(byte_library):
    texts = [t or "" for t in odd_texts(1500, 5)]
    codec = bpe.Codec.from_json(bpe.read_vocabulary(BYTES))
    ids, row = codec.encode(*column_bytes(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[row[i]:row[i + 1]].tolist() == byte_library.encode(t, add_special_tokens=False).ids


# ---- 11: SentencePiece -------------------------------------------------
def compare(codec, library, texts):
    data, off = column_bytes(pa.array(texts, pa.string()))
    ids, row, begin, end = codec.encode(data, off)
    decoded = codec.decode_rows(ids, row)
    for i, t in enumerate(texts):
        a, b = row[i], row[i + 1]
        want = library.encode(t or "", return_type="proto").pieces
        assert ids[a:b].tolist() == [p.id for p in want]
        assert list(zip(begin[a:b] - off[i], end[a:b] - off[i])) == [(p.begin, p.end) for p in want]
        assert decoded[i].decode() == codec.decode(ids[a:b].tolist()).decode() == library.decode(ids[a:b].tolist())


def test_pieces_spans_and_text_equal_the_library(library):
    compare(pieces.PieceCodec(pieces.read_model(PIECES)), library, odd_texts(2000))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("trim", [True, False])
def test_character_maps_equal_the_library(tmp_path, rule, prefix, trim):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    rules, model = pb.ModelProto(), pb.ModelProto()
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    model.ParseFromString(open(PIECES, "rb").read())
    spec = model.normalizer_spec
    spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces = rules.normalizer_spec.precompiled_charsmap, prefix, trim
    path = str(tmp_path / "m.model")
    open(path, "wb").write(model.SerializeToString())
    compare(pieces.PieceCodec(pieces.read_model(path)), sentencepiece.SentencePieceProcessor(model_file=path), odd_texts(600))


def test_any_ids_decode_as_in_the_library(library):
    rng, codec = random.Random(2), pieces.PieceCodec(pieces.read_model(PIECES))
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3), 259, 28705]) for _ in range(rng.randint(0, 8))]
        assert codec.decode(ids).decode() == library.decode(ids)


def test_op11_rows(spark, docs, library):
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, r.text or "")
    got = pieces.round_trip(docs, PIECES).collect()
    assert len(got) == docs.count()
    for r in got:
        for t in {texts[r.doc_id], "the the"} if r.doc_id == 7 else {texts[r.doc_id]}:
            ids = library.encode(t)
            if len(ids) == r.n_tokens:
                assert (r.ids_sha256, r.decoded_sha256) == (sha(",".join(map(str, ids)).encode()), sha(library.decode(ids).encode()))
                assert r.n_covered == len(t.encode())
                break
        else:
            raise AssertionError(r)
    enc = pieces.encode(docs.where("doc_id > 10"), PIECES)
    back = {r.doc_id: r.text for r in pieces.decode(enc, PIECES).collect()}
    assert all(back[r.doc_id] == library.decode(r.ids) for r in enc.collect())
    empty = spark.createDataFrame([], SCHEMA)
    assert pieces.round_trip(empty, PIECES).count() == pieces.encode(empty, PIECES).count() == 0


def test_op11_whole_table(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op11_sentencepiece"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()), sha(library.decode(ids).encode()))


# ---- 12: alignment -----------------------------------------------------
def brute_alignment(texts, byte_library, library):
    """Per row: (n_a, n_b, n_groups, links, digest text), by walking all token pairs that may overlap."""
    char = bpe.byte_of_char()
    out = []
    for t in texts:
        ids_a = byte_library.encode(" " + (t or ""), add_special_tokens=False).ids
        ids_b = library.encode(t or "")
        a = [bytes(char[c] for c in byte_library.id_to_token(i)) for i in ids_a]
        names = [library.id_to_piece(i) for i in ids_b]
        b = [bytes([int(p[3:-1], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode() for p, i in zip(names, ids_b)]
        want = (" " + (t or "")).encode()
        if not t or b"".join(a) != want or b"".join(b) != want:
            out.append((0, 0, 0, [], ""))
            continue
        ea, eb = np.cumsum([len(x) for x in a]), np.cumsum([len(x) for x in b])
        links = []
        for i, e in enumerate(ea):
            s = e - len(a[i])
            for j in range(int(np.searchsorted(eb, s, "right")), len(eb)):
                if eb[j] - len(b[j]) >= e:
                    break
                links.append((ids_a[i], ids_b[j]))
        groups, i, j = [], 0, 0
        for cut in sorted(set(ea) & set(eb)):
            ni, nj = int(np.searchsorted(ea, cut)) + 1, int(np.searchsorted(eb, cut)) + 1
            groups.append(",".join(map(str, ids_a[i:ni])) + "|" + ",".join(map(str, ids_b[j:nj])))
            i, j = ni, nj
        out.append((len(a), len(b), len(groups), links, ";".join(groups)))
    return out


def check_alignment(rows, texts, byte_library, library):
    found = brute_alignment(texts, byte_library, library)
    counts = Counter(p for *_, links, _ in found for p in set(links))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    want = sorted((n_a, n_b, n_g, len(links), sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links), sha(d.encode()) if d else "")
                  for n_a, n_b, n_g, links, d in found)
    assert sorted((r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows) == want


@pytest.mark.parametrize("frequent", [0, 100, 1 << 19])
def test_op12_rows(spark, docs, byte_library, library, frequent):
    got = crosstok.alignment(docs.repartition(5), BYTES, PIECES, frequent=frequent).collect()
    check_alignment(got, [r.text for r in docs.collect()], byte_library, library)
    numbers = {r.doc_id: (r.n_a, r.n_b) for r in got}
    assert numbers[5] == (len(byte_library.encode(" " + "a" * 3000, add_special_tokens=False).ids), len(library.encode("a" * 3000)))
    zero = [r for r in got if r.doc_id in (0, 1, 6)]
    assert all((r.n_a, r.n_b, r.n_links, r.count_sum, r.groups_sha256) == (0, 0, 0, 0, "") for r in zero)


def test_op12_whole_table_and_empty(spark, byte_library, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_alignment(QUERIES["op12_cross_tokenizer_alignment"](spark, SF).collect(), [r.text for r in docs.collect()], byte_library, library)
    empty = spark.createDataFrame([], SCHEMA)
    assert crosstok.alignment(empty, BYTES, PIECES).count() == crosstok.spans(empty, BYTES, PIECES).count() == 0


def test_spans_join_to_the_ids(spark, docs):
    some = docs.where("doc_id > 8 and doc_id <> 7")
    spans = defaultdict(list)
    for r in crosstok.spans(some, BYTES, PIECES).collect():
        spans[r.doc_id].append((r.group, r.a_ids, r.b_ids))
    numbers = {r.doc_id: r for r in crosstok.alignment(some, BYTES, PIECES).collect()}
    for d, r in numbers.items():
        groups = sorted(spans.get(d, []))
        assert [g for g, *_ in groups] == list(range(r.n_groups))
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for _, a, b in groups)
        assert r.groups_sha256 == (sha(text.encode()) if text else "")


# ---- 13: conversations -------------------------------------------------
def cheapest(rows):
    """(cost, edits) by Dijkstra over (row, state), whole strings compared."""
    heap, seen = [(0, "", 0, 0)], set()
    while True:
        c, s, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows) and state in (0, 3):
            return c, s
        need = "a" if state == 2 else "u"
        then = 3 if need == "a" else 2
        heapq.heappush(heap, (c + 5, s + "I", i, then))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (c + 2, s + "D", i + 1, state))
            if fault in "kt":
                more = 5 * (fault == "t")
                heapq.heappush(heap, (c + 1 + more, s + "R", i + 1, then))
                if initial == need:
                    heapq.heappush(heap, (c + more, s + "K", i + 1, then))
                if initial == "s" and state == 0:
                    heapq.heappush(heap, (c + more, s + "K", i + 1, 1))


def brute_repair(rows):
    """{conv: columns} of (conv, turn, role, text) rows after damage."""
    by = defaultdict(list)
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        by[c].append((t is not None, t or 0, role, hashlib.sha256(text.encode()).digest(), text))
    out = {}
    for c, turns in by.items():
        turns.sort()
        seen, faults = set(), []
        for _, _, role, _, text in turns:
            solid = text.strip(conversations.WHITE)
            faults.append("b" if not solid else "d" if (role, text) in seen else "k" if solid[-1] in ".!?" else "t")
            seen.add((role, text))
        initials = [x[2][:1] for x in turns]
        cost, edits = cheapest(list(zip(initials, faults)))
        repaired, i, last = [], 0, ""
        for e in edits:
            role = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
            if e == "D":
                i += 1
                continue
            role = turns[i][2] if e == "K" else role
            repaired.append((role, "" if e == "I" else turns[i][4]))
            last = role[:1]
            i += e != "I"
        known = [x[1] for x in turns if x[0]]
        out[c] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, edits,
                  sha("\n".join(f"{r}:{t}" for r, t in repaired).encode())), repaired
    return out


def check_repair(got, rows):
    want = {c: v[0] for c, v in brute_repair(rows).items()}
    assert {r.conv_id: (*(r[c] for c in conversations.SUMMARY), r.audit, r.repaired_sha256) for r in got} == want


def test_search_finds_the_least_edits():
    rng = random.Random(3)
    for _ in range(1500):
        rows = [(rng.choice(["u", "u", "a", "a", "a", "s", "x", " ", ""]), rng.choice("kkkkkkbdt")) for _ in range(rng.randint(0, 10))]
        assert conversations.repair_block(rows) == cheapest(rows)


def test_folded_blocks_give_the_least_edits():
    rng = random.Random(9)
    for _ in range(200):
        rows = [(rng.choice("uuaaasx"), rng.choice("kkkkkkbdt")) for _ in range(rng.randint(1, 40))]
        tables, i = [], 0
        while i < len(rows):
            k = rng.randint(1, 7)
            tables.append(conversations.block_table(rows[i:i + k]))
            i += k
        cost, path = conversations.fold(tables)
        edits = "".join(t[1][4 * a + b] for t, (a, b) in zip(tables, path)) + "I" * conversations._TAIL[path[-1][1]]
        assert (cost, edits) == cheapest(rows)


def odd_conversations():
    rng = random.Random(7)
    says = ["Yes.", "No!", "Why?", "and then", "", " \n", None, "Ends.  \t", "日本。", "x" * 20000 + "."]
    rows = [(c, rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", "tool", "", None, "umbrella"]), rng.choice(says))
            for c in [None, *range(60)] for _ in range(rng.randint(1, 9))]
    rows += [(100, i, "user" if i % 2 else "assistant", f"turn {i // 3}{rng.choice('.. ')}") for i in range(700)]   # one hot conversation
    rows += [(101, 3, "user", "again.")] * 200 + [(102, None, None, None)]
    return rows


CONV = "conv_id long, turn long, role string, text string"


def test_op13_odd_rows_and_a_hot_conversation(spark):
    rows = odd_conversations()
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], CONV + ", c int, key string, cost int").repartition(7)
    got = conversations.repair(df).collect()
    check_repair(got, rows)
    turns = defaultdict(list)
    for r in conversations.repaired_turns(df).collect():
        turns[r.conv_id].append((r.pos, r.role, r.text))
    for c, (_, repaired) in brute_repair(rows).items():
        assert sorted(turns.get(c, [])) == [(i, *x) for i, x in enumerate(repaired)]
    assert conversations.repair(spark.createDataFrame([], CONV)).count() == 0


def brute_damage(rows):
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if k:
            text = "" if k == 1 else text.translate({ord(x): None for x in ".!?"}) if k == 2 else text
            yield from [(c, t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)


def test_op13_damage(spark):
    rows = odd_conversations()
    got = conversations.damage(spark.createDataFrame(rows, CONV))
    assert Counter(map(tuple, got.collect())) == Counter(brute_damage(rows))


def test_op13_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversation_repair"](spark, sf).collect()
    gone = [r for r in got if r.conv_id not in {x[0] for x in brute_damage(rows)}]
    assert len(got) == len({x[0] for x in rows}) and all((r.cost, r.audit, r.repaired_sha256) == (0, "", sha(b"")) for r in gone)
    check_repair([r for r in got if r not in gone], list(brute_damage(rows)))
