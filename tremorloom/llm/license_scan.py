"""License scan (operator 3): Aho-Corasick over the word stream, a shunting-yard parser for licence expressions.

One automaton finds base phrases, notice phrases and the identifier tag in the normalised word stream
(words joined by single spaces), so that phrases match across any separators. Where the tag is met, the expression behind it
is read from the text, turned into postfix order by the shunting-yard algorithm, and evaluated twice: for the
licences it names and for whether a policy permits it (``OR``: either side, ``AND``: both, ``WITH``: the licence, or an
exception that the policy accepts).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tremorloom.llm.common import _ALNUM, id_and_bytes, texts_of

# Base phrases and their labels
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notice phrases of well-known licences and their labels
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache",
    "free software foundation": "gpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "reserved",
}
TAG = "spdx license identifier"
# Families of licence identifiers by their first part
FAMILIES = ("0bsd", "agpl", "apache", "bsd", "bsl", "cc0", "cc", "epl", "gpl", "isc", "lgpl", "mit", "mpl", "unlicense", "zlib")
#: families and exceptions of the default policy
PERMISSIVE = frozenset(("0bsd", "apache", "bsd", "bsl", "cc0", "isc", "mit", "unlicense", "zlib"))
EXCEPTIONS = frozenset(("classpath-exception-2.0", "llvm-exception"))

_TAG_LINE = re.compile(rb"spdx[^a-z0-9\x80-\xff]+license[^a-z0-9\x80-\xff]+identifier[ \t]*:?[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"\(|\)|[a-z0-9.+:-]+")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def postfix(expression: str) -> list[str]:
    """Shunting-yard: identifiers and operators in postfix order. What follows a complete expression is a comment.

    Raises ValueError where there is no expression.
    """
    out: list[str] = []
    stack: list[str] = []
    operand = True  # an operand is expected
    depth = 0
    for token in _TOKEN.findall(expression.lower()):
        if operand:
            if token == "(":
                stack.append(token)
                depth += 1
            elif token in _PRECEDENCE or token == ")" or not re.search("[a-z0-9]", token):
                raise ValueError(f"{token} where a licence is expected")
            else:
                out.append(token)
                operand = False
        elif token in _PRECEDENCE:
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = True
        elif token == ")" and depth:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        else:
            break
    if operand or depth:
        raise ValueError("the expression ends too early")
    return out + stack[::-1]


def family(identifier: str) -> str:
    """The family of an identifier such as ``apache-2.0`` or ``gpl-2.0+``; ``other`` if unknown."""
    head = re.split(r"[-+:.]", identifier, maxsplit=1)[0]
    return ("cc-by" if identifier.startswith("cc-by") else head) if head in FAMILIES else "other"


@lru_cache(maxsize=100_000)
def evaluate(expression: str, permissive: frozenset = PERMISSIVE, exceptions: frozenset = EXCEPTIONS) -> tuple[frozenset, bool]:
    """``(families, permitted)`` of an expression."""
    values: list[tuple[frozenset, bool, str]] = []
    for token in postfix(expression):
        if token in _PRECEDENCE:
            right, left = values.pop(), values.pop()
            if token == "with":
                values.append((left[0], left[1] or right[2] in exceptions, left[2]))
            elif token == "and":
                values.append((left[0] | right[0], left[1] and right[1], ""))
            else:
                values.append((left[0] | right[0], left[1] or right[1], ""))
        else:
            name = family(token)
            values.append((frozenset((name,)), name in permissive, token))
    return values[0][0], values[0][1]


@lru_cache(maxsize=4)
def automaton(notices: tuple):
    """Aho-Corasick automaton of all phrases, each between spaces; built once per worker."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for phrase in {**dict(notices), **BASE, TAG: ""}:
        key = f" {phrase} "
        machine.add_word(key, (len(key), BASE.get(phrase), dict(notices).get(phrase), phrase == TAG))
    machine.make_automaton()
    return machine


def scan(text: bytes, notices: tuple) -> tuple:
    """All fields of one text; the whole of it."""
    plain = text.translate(_ALNUM)
    words = plain.split()
    stream = b" " + b" ".join(words) + b" "
    starts, base, extra, tagged, phrases = [], set(), set(), False, 0
    at, index = 0, 0
    for end, (length, own, notice, tag) in sorted(automaton(notices).iter(stream.decode("latin-1")), key=lambda m: m[0] - m[1][0]):
        start = end + 1 - length
        index += stream.count(b" ", at, start)
        at = start
        if own:
            starts.append(index)
            base.add(own)
        if notice:
            extra.add(notice)
            phrases += 1
        tagged |= tag
    expressions, permitted, broken = [], [], 0
    if tagged:
        for match in _TAG_LINE.finditer(text.lower()):
            expression = match[1].decode("utf-8", "replace").strip()
            try:
                families, allowed = evaluate(expression)
            except ValueError:
                broken += 1
                continue
            expressions.append(expression)
            permitted.append(allowed)
            extra |= families
    evidence = len(starts) + phrases
    score = 1.0 if expressions else 1.0 - 0.5 ** min(evidence, 50) if evidence else 0.0
    return len(words), starts, base, base | extra, expressions, all(permitted) if permitted else None, broken, score


def license_scan(docs: DataFrame, notices: Iterable[tuple[str, str]] = tuple(NOTICES.items()), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, expressions, permitted, n_broken, score``.

    Each row is scanned on its own and whole: repeated rows give repeated results, a NULL id stays NULL, NULL and empty texts
    have no words, empty label texts, no expressions and a score of 0; an empty table gives no rows. The score is 1 with a
    valid expression, else ``1 - 2**-n`` for n phrases. An expression that can't be parsed counts in ``n_broken`` only.
    """
    notices = tuple(notices)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for ids, texts in texts_of(batches):
            found = [scan(t, notices) for t in texts]
            starts = [f[1] for f in found]
            yield pa.record_batch(
                {
                    "doc_id": ids,
                    "n_words": pa.array([f[0] for f in found], pa.int64()),
                    "n_base": pa.array([len(s) for s in starts], pa.int64()),
                    "first_word": pa.array([min(s, default=None) for s in starts], pa.int64()),
                    "last_word": pa.array([max(s, default=None) for s in starts], pa.int64()),
                    "base_labels": pa.array([",".join(sorted(f[2])) for f in found], pa.string()),
                    "labels": pa.array([",".join(sorted(f[3])) for f in found], pa.string()),
                    "expressions": pa.array([f[4] for f in found], pa.list_(pa.string())),
                    "permitted": pa.array([f[5] for f in found], pa.bool_()),
                    "n_broken": pa.array([f[6] for f in found], pa.int64()),
                    "score": pa.array([f[7] for f in found], pa.float64()),
                }
            )

    return id_and_bytes(docs, id_col, text_col).mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "expressions array<string>, permitted boolean, n_broken long, score double",
    )
