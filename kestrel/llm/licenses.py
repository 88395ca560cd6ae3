"""Licence scan: Aho-Corasick finds identifier tags and notice phrases, a
shunting-yard parser evaluates the and/or/with expressions behind the tags.

One automaton per task holds all phrases, in the normalised form of a text (its
lower-cased words with single spaces around), so a match stands on word
boundaries and its place is a word number.  Tags (``SPDX-License-Identifier:``
and the like) are found by a second automaton in the raw text, and
the expression after a tag is tokenised to the end of its line.

Evaluation: a licence has an openness between 0 and 1; ``or`` leaves the choice (the
larger value), ``and`` imposes both (the smaller), ``with`` adds an exception, which
halves the distance to 1.  An identifier of no known family is a label of its own if it looks
like one (it has a digit or a hyphen); its openness is unknown, which counts as 0 under
``and`` and as no choice under ``or``."""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kestrel.llm.textkit import ALNUM_WORD, Chunk, map_chunks

# Base phrases and their labels.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Further notice phrases.
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "gnu general public licence": "gpl", "gnu free documentation license": "gfdl",
    "apache software license": "apache", "mit licence": "mit",
    "permission is hereby granted free of charge": "mit",
    "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd", "mozilla public license": "mpl",
    "eclipse public license": "epl", "boost software license": "bsl", "isc license": "isc", "the unlicense": "unlicense",
    "creative commons attribution": "cc-by", "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd", "cc0": "cc0", "public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
# Identifier tags (lower case).
TAGS = ["spdx-license-identifier:", "license-expression:", "license:", "licence:"]
# Families of identifiers by beginning (longest first wins) with their openness.
FAMILIES = {
    "agpl": 0.2, "lgpl": 0.5, "gpl": 0.3, "gfdl": 0.3, "apache": 0.9, "mit": 1.0, "bsd": 1.0, "mpl": 0.6, "epl": 0.6, "bsl": 1.0,
    "isc": 1.0, "unlicense": 1.0, "zlib": 1.0, "cc0": 1.0, "public-domain": 1.0, "cc-by-nc-sa": 0.15, "cc-by-nc-nd": 0.1, "cc-by-nc": 0.2,
    "cc-by-sa": 0.4, "cc-by-nd": 0.2, "cc-by": 0.8, "all-rights-reserved": 0.0,
}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[a-z0-9.+_-]+")
_IDENTIFIER = re.compile(r"(?=.*[a-z])(?=.*[0-9-])[a-z0-9][a-z0-9.+_-]*")


def family(name: str) -> str | None:
    """Family of a licence identifier: the longest known beginning."""
    known = [f for f in FAMILIES if name == f or name.startswith((f + "-", f + "+")) or re.match(re.escape(f) + r"v?\d", name)]
    return max(known, key=len) if known else None


def to_postfix(tokens: Iterable[str]) -> list[str] | None:
    """Shunting-yard: postfix order of the longest well-formed beginning; None if
    no licence stands at the start."""
    out, stack, operand, depth, good, rest = [], [], True, 0, 0, []
    for t in tokens:
        if operand:
            if t == "(":
                stack.append(t)
                depth += 1
                continue
            if t == ")" or t in PRECEDENCE:
                break
            out.append(t)
            operand = False
        elif t == ")":
            if not depth:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        elif t in PRECEDENCE:
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[t]:
                out.append(stack.pop())
            stack.append(t)
            operand = True
        else:
            break
        if not operand and not depth:
            good, rest = len(out), stack[::-1]      # outside brackets the stack holds three operators at most
    return out[:good] + rest if good else None


def evaluate(postfix: list[str]) -> tuple[set[str], float] | None:
    """(labels, openness) of a postfix expression; None if no licence is in it.  Unknown openness: 0."""
    stack = []
    for t in postfix:
        if t not in PRECEDENCE:
            f = family(t)
            own = {f} if f else {t.rstrip(".-")} if _IDENTIFIER.fullmatch(t) else set()
            stack.append((own, FAMILIES[f] if f else None))
            continue
        (fb, b), (fa, a) = stack.pop(), stack.pop()
        if t == "with":                                         # the right side names an exception
            stack.append((fa, None if a is None else (a + 1) / 2))
        elif t == "or":
            stack.append((fa | fb, max((v for v in (a, b) if v is not None), default=None)))
        else:   # a side without any label says nothing, one with an unknown licence allows nothing
            values = [v or 0.0 for f, v in ((fa, a), (fb, b)) if f]
            stack.append((fa | fb, min(values) if values else None))
    labels, value = stack[-1]
    return (labels, value or 0.0) if labels else None


def parse_expression(text: str, start: int = 0) -> tuple[set[str], float] | None:
    """Families and openness of the expression at ``start``, up to its line's end."""
    stop = text.find("\n", start)
    tokens = _TOKEN.finditer(text, start, stop if stop >= 0 else len(text))
    postfix = to_postfix(m.group() for m in tokens)
    return evaluate(postfix) if postfix else None


class Scanner:
    """Automata and tables of one task."""

    def __init__(self, base: dict[str, str], notices: dict[str, str], tags: list[str]):
        import ahocorasick
        self.phrases = ahocorasick.Automaton()
        for p in {**notices, **base}:
            key = " " + p + " "
            self.phrases.add_word(key, (key, base.get(p), notices.get(p)))
        self.tag_bytes = [t.encode() for t in tags]
        self.tags = ahocorasick.Automaton()
        for t in tags:
            self.tags.add_word(t, t)
        self.phrases.make_automaton()
        self.tags.make_automaton()
        self.to_space = bytes(b if ok else 0x20 for b, ok in enumerate(ALNUM_WORD))

    def scan(self, text: bytes) -> tuple:
        low = text.lower()
        words = low.translate(self.to_space).split(b" ")
        words = [w for w in words if w]
        flat = (b" " + b" ".join(words) + b" ").decode("utf-8", "replace") if words else ""
        found, extra = [], set()
        done, upto = 0, 0
        for end, (key, base, notice) in sorted(((e, v) for e, v in self.phrases.iter(flat)), key=lambda x: x[0] - len(x[1][0])):
            start = end - len(key) + 1
            done += flat.count(" ", upto, start)
            upto = start
            if base is not None:
                found.append((done, base))
            if notice is not None:
                extra.add(notice)
        openness = []
        if any(t in low for t in self.tag_bytes):
            raw = low.decode("utf-8", "replace")
            for end, tag in self.tags.iter(raw):
                got = parse_expression(raw, end + 1)
                if got:
                    extra |= got[0]
                    openness.append(got[1])
        labels = {b for _, b in found} | extra
        values = openness or [FAMILIES[x] for x in labels if x in FAMILIES]
        starts = [s for s, _ in found]
        return (len(words), len(found), min(starts, default=None), max(starts, default=None),
                ",".join(sorted({b for _, b in found})), ",".join(sorted(labels)), min(values) if values else 0.0)


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", base: dict | None = None, notices: dict | None = None,
         tags: list | None = None) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    n_base counts all places of the base phrases, first_word and last_word are their
    smallest and largest start (words from 0, null without a place).  ``labels`` adds the
    notices' and expressions' families to the base labels.  score is the openness
    of the licences found: of the tagged expressions if there are any, else of
    the labels, the smallest each; 0 without any licence.  Null and empty texts have no
    words and empty labels; repeated rows are scanned each."""
    args = (base or BASE_PHRASES, notices or NOTICE_PHRASES, tags or TAGS)

    def one(chunk: Chunk, scanner: Scanner):
        rows = list(zip(*map(scanner.scan, chunk.texts()))) or [[]] * 7
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        return pa.RecordBatch.from_arrays([chunk.column(id_col), *[pa.array(r, k) for r, k in zip(rows, kinds)]], names=schema.names)

    long, string = T.LongType(), T.StringType()
    schema = T.StructType([docs.schema[id_col], *[T.StructField(c, long) for c in ("n_words", "n_base", "first_word", "last_word")],
                           T.StructField("base_labels", string), T.StructField("labels", string), T.StructField("score", T.DoubleType())])
    return map_chunks(docs.select(id_col, text), schema, one, text, lambda: Scanner(*args))
