"""License scans: Aho-Corasick finds notice phrases and identifier tags, a shunting-yard parser their expressions."""

from __future__ import annotations

import bisect
import re
from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import pick, table
from .phrases import automaton, matches
from .words import NOT_ALNUM, buffer, parts, words

#: The notice phrases of the contract and their labels.
NOTICES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further phrases that stand for an identifier, and that identifier as an expression.
IDENTIFIERS = {"cc by nc": "CC-BY-NC", "cc by sa": "CC-BY-SA", "cc0": "CC0", "apache license version 2 0": "Apache-2.0", "gnu general public license version 2": "GPL-2.0", "gnu general public license version 3": "GPL-3.0", "gnu lesser general public license": "LGPL", "mozilla public license": "MPL"}
#: An expression follows it in the original text, up to the end of the line.
TAG = "spdx license identifier"
#: identifiers' first parts, by longest first, their labels and how freely they allow reuse (0 to 1).
FAMILIES = {"AGPL": ("agpl", 0.1), "LGPL": ("lgpl", 0.4), "GPL": ("gpl", 0.2), "Apache": ("apache", 1.0), "MIT": ("mit", 1.0), "BSD": ("bsd", 1.0), "ISC": ("isc", 1.0), "MPL": ("mpl", 0.5), "CC-BY-NC": ("cc-by-nc", 0.1), "CC-BY-SA": ("cc-by-sa", 0.5), "CC-BY": ("cc-by", 0.8), "CC0": ("cc0", 1.0), "Unlicense": ("unlicense", 1.0)}
_OPERATORS = {"OR": 1, "AND": 2, "WITH": 3}
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
RESULT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, notices array<struct<label:string,first_word:int,first_char:int,end_char:int>>"


#: What may follow a family in an identifier of the public list, besides version numbers.
QUALIFIERS = ("only", "or", "later", "clause", "nc", "nd", "sa", "patent", "clear", "attribution")
_TAIL = re.compile(rf"(-([0-9]+(\.[0-9]+)*|{'|'.join(QUALIFIERS)}))*\+?")
_OWN = "licenseref-"


def family(identifier: str) -> tuple[str, float] | None:
    """Its family's label and how freely that allows reuse; None if it is no identifier.

    Identifiers are a family and versions or qualifiers (GPL-2.0-or-later, BSD-3-Clause), or a name of one's own
    after LicenseRef-, which is its own family and allows nothing that is known.
    """
    low = identifier.lower()
    if low.startswith(_OWN) and low != _OWN:
        return low, 0.0
    for name, value in FAMILIES.items():
        if low.startswith(name.lower()) and _TAIL.fullmatch(low, len(name)):
            return value
    return None


def _operand(identifier: str) -> tuple[set[str], float | None]:
    """Its family, and itself if it says more; nothing if it is no identifier."""
    known = family(identifier)
    return ({known[0], identifier.lower()}, known[1]) if known else (set(), None)


def reading(expression: str) -> tuple[list[str], int]:
    """Shunting-yard: (operands and operators in postfix order, end) of as much of the line as reads as an expression.

    Nothing behind the first token that does not read is looked at.  WITH binds tighter than AND, AND tighter than OR; operators associate to the left and may be in any case.
    """
    out: list[str] = []
    held: list[str] = []
    want_operand, brackets, end = True, 0, 0
    for match in _TOKEN.finditer(expression):
        token = match[0]
        op = token.upper()
        if token == "(":
            if not want_operand:
                break
            held.append(token)
            brackets += 1
        elif token == ")":
            if want_operand or not brackets:
                break
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
            brackets -= 1
        elif op in _OPERATORS:
            if want_operand:
                break
            while held and held[-1] != "(" and _OPERATORS[held[-1]] >= _OPERATORS[op]:
                out.append(held.pop())
            held.append(op)
            want_operand = True
        else:
            if not want_operand:
                break
            out.append(token)
            want_operand = False
        end = match.end()
    while want_operand and held:  # an operator without its right side goes, with the brackets open after it
        want_operand = held.pop() == "("
    out += [x for x in reversed(held) if x != "("]
    return out, end


def postfix(expression: str) -> list[str]:
    return reading(expression)[0]


def evaluate(expression: str) -> tuple[set[str], float] | None:
    """The labels an expression names, and how freely it allows reuse: the least of AND's sides, the best of OR's.

    Words that are no identifiers name nothing, and the other side of their operator stands alone; None if the
    expression has no identifier.
    """
    return _value(postfix(expression))


def _value(tokens: list[str]) -> tuple[set[str], float] | None:
    stack: list[tuple[set[str], float | None]] = []
    for token in tokens:
        if token in _OPERATORS:
            (b, y), (a, x) = stack.pop(), stack.pop()
            known = [v for v in (x, y) if v is not None]
            # an exception names no licence of its own and only adds to what its licence allows
            stack.append((a, x) if token == "WITH" else (a | b, (min if token == "AND" else max)(known, default=None)))
        else:
            stack.append(_operand(token))
    return stack[-1] if stack and stack[-1][0] else None


def _in_characters(raw: bytes, places: list[tuple[str, int, int, int]]) -> list[tuple[str, int, int, int]]:
    """places with offsets in characters instead of bytes, all counted in one pass over the text."""
    if not places:
        return places
    begins = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    count, last, n = {}, 0, 0
    for at in sorted({x for p in places for x in p[2:]}):
        n += int(np.count_nonzero(begins[last:at]))
        count[at], last = n, at
    return [(label, word, count[low], count[high]) for label, word, low, high in places]


def scan_licenses(docs: DataFrame, notices: Mapping[str, str] = NOTICES, identifiers: Mapping[str, str] = IDENTIFIERS, tag: str = TAG) -> DataFrame:
    """A row per row of docs (doc_id, text): see RESULT.

    n_base counts the places of notice phrases, first_word and last_word are the smallest and largest word they
    start at (words from 0; null if there is none), notices has each with its character offsets in the original
    text.  labels adds to base_labels what expressions after the name and what phrases that stand for an identifier do (see family()).  score says how freely the
    licences found allow reuse: the least over expressions and phrases, 0 if nothing is found.

    An expression goes on to the end of its line, or to the next tag, as far as it reads as one.  Work and memory grow with a
    text's length, however many tags and phrases a line has.

    Null and empty texts have no words and no labels (empty strings); overlapping phrases each count; an
    expression that does not parse adds as much as parses; repeated rows give a row each; an empty table gives no
    rows; other columns are ignored.
    """
    phrases = [p.encode() for p in (*notices, *identifiers, tag)]
    labels, named = list(notices.values()), list(identifiers.values())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(("phrases", *phrases), phrases)
        for batch in parts(batches):
            w = words(batch.column(1), NOT_ALNUM, lower=True)
            raw = [w.bytes_of(i) for i in range(batch.num_rows)]
            hits: dict[int, list] = defaultdict(list)
            for text, a, b, phrase in matches(found, raw):
                hits[text].append((a, b, phrase))
            data, out = buffer(batch.column(1))[0], []
            for i in range(batch.num_rows):
                n, at = int(w.first[i + 1] - w.first[i]), int(w.first[i])
                base, more, free, expressions, places = set(), set(), [], [], []
                own = hits.get(i, ())
                tags = [int(w.start[at + a] - w.offsets[i]) for a, _, phrase in own if phrase == len(phrases) - 1]
                text = data[w.offsets[i] : w.offsets[i + 1]].tobytes() if tags else b""
                for a, b, phrase in own:
                    if phrase < len(labels):
                        base.add(labels[phrase])
                        free.append(family(labels[phrase])[1])
                        places.append((labels[phrase], a, int(w.start[at + a] - w.offsets[i]), int(w.end[at + b - 1] - w.offsets[i])))
                    elif phrase < len(labels) + len(named):
                        value = evaluate(named[phrase - len(labels)])
                        more |= value[0]
                        free.append(value[1])
                    else:
                        high = int(w.end[at + b - 1] - w.offsets[i])
                        k = bisect.bisect_left(tags, high)
                        stop = tags[k] if k < len(tags) else len(text)
                        line = text.find(b"\n", high, stop)
                        rest = text[high : stop if line < 0 else line].decode("utf-8", "replace").lstrip(" \t:=")
                        tokens, end = reading(rest)
                        if value := _value(tokens):
                            more |= value[0]
                            free.append(value[1])
                            expressions.append(rest[:end])
                places = _in_characters(raw[i], places)
                starts = [p[1] for p in places]
                out.append((n, len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), min(free, default=0.0), expressions, [dict(zip(("label", "first_word", "first_char", "end_char"), p, strict=True)) for p in places]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int32()), ("first_char", pa.int32()), ("end_char", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "notices"])

    return pick(docs, doc_id="long", text="string").mapInArrow(scan, RESULT)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
