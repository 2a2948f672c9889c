"""An Aho-Corasick automaton over phrases of words, run over many texts at once.

Texts are put in the form " w1 w2 ... \\n": words in lower case with a space on each side, one text after the
other.  A phrase is " w1 w2 ", so a match covers whole words of one text.  Bytes stand for characters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np

from .words import LOWER, NOT_ALNUM

_PLAIN = bytes(32 if NOT_ALNUM[b] else b for b in range(256))
_automata: dict[object, ahocorasick.Automaton] = {}


def normal(text: bytes) -> bytes:
    """Its words in lower case with single spaces between."""
    return b" ".join(text.translate(LOWER).translate(_PLAIN).split())


def automaton(key: object, phrases: Sequence[bytes]) -> ahocorasick.Automaton:
    """Finds phrases given as by normal(); kept in the worker under `key`.  A match's value is (index, words)."""
    if key not in _automata:
        _automata.clear()  # one at a time bounds a worker's memory
        made = ahocorasick.Automaton()
        for i, phrase in enumerate(phrases):
            made.add_word(f" {phrase.decode('latin-1')} ", (i, phrase.count(b" ") + 1))
        if phrases:
            made.make_automaton()
        _automata[key] = made
    return _automata[key]


def matches(found: ahocorasick.Automaton, texts: Sequence[bytes]) -> Iterator[tuple[int, int, int, int]]:
    """(text, first word, end word, phrase) of every place of every phrase."""
    if not len(found):
        return
    lines = [b" %b \n" % n if (n := normal(t)) else b"\n" for t in texts]
    joined = b"".join(lines)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.zeros(len(lines) + 1, np.int64)
    np.cumsum([len(x) for x in lines], out=starts[1:])
    first = np.searchsorted(spaces, starts)  # the number of spaces before each text
    hits = [(end, *value) for end, value in found.iter(joined.decode("latin-1"))]
    if not hits:
        return
    end, phrase, n = np.array(hits).T
    text = np.searchsorted(starts, end, "right") - 1
    last = np.searchsorted(spaces, end) - first[text]  # words before the space that ends the match
    yield from zip(text.tolist(), (last - n).tolist(), last.tolist(), phrase.tolist(), strict=True)
