"""Where the byte-level pre-tokenizer starts a word, as a transducer over character classes.

Decisions that need the next character are emitted one character late.
A text is cut into chunks; a chunk's state map says, for every state it
may start in, the state it ends in.  Maps compose through a parallel
prefix scan, which gives every chunk its true start, and all chunks step
together as lanes.
"""

from __future__ import annotations

import unicodedata

import numpy as np

CHUNK = 256
#: A lone surrogate: never part of valid text, so it can part the texts of a block.
SEP = "\ud800"
#: Unicode White_Space, as the pre-tokenizer's ``\s`` has it (fixed values).
SPACE_CHARS = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")

# character classes: single-letter contractions, first letters of the long ones, their second letters
LETTER, STMD, RV, EL, E, NUMBER, OTHER, APOSTROPHE, BLANK, SPACE, END = range(11)
# states of the word transducer
(FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, QUOTE, QUOTE_RV, QUOTE_L,
 ONE_BLANK, ONE_SPACE, RUN_BLANK, RUN_SPACE) = range(11)
_LETTERS = (LETTER, STMD, RV, EL, E)


def _word_transducer() -> np.ndarray:
    """cell[state, class] = next state * 4 + starts before the previous character * 2 + before this one."""
    cell = np.zeros((11, 11), np.uint8)

    def enter(c: int, after_blank: bool) -> int:
        """State after a word's first character (a blank before it belongs to the word)."""
        if c in _LETTERS:
            return IN_LETTERS
        if c == NUMBER:
            return IN_NUMBERS
        if c == APOSTROPHE and not after_blank:
            return QUOTE
        return {BLANK: ONE_BLANK, SPACE: ONE_SPACE, END: FRESH}.get(c, IN_OTHERS)
    for s in range(11):
        for c in range(11):
            before_previous, here, to = 0, 1, enter(c, False)
            run = {IN_LETTERS: _LETTERS, IN_NUMBERS: (NUMBER,), IN_OTHERS: (OTHER, APOSTROPHE), QUOTE: (OTHER, APOSTROPHE)}
            if c == END:
                before_previous = int(s in (QUOTE_RV, QUOTE_L))
            elif s in run and c in run[s]:
                here, to = 0, IN_OTHERS if s == QUOTE else s
            elif s == QUOTE and c in (STMD, RV, EL):
                here, to = 0, {STMD: FRESH, RV: QUOTE_RV, EL: QUOTE_L}[c]
            elif s == QUOTE_RV and c == E or s == QUOTE_L and c == EL:
                here, to = 0, FRESH
            elif s in (QUOTE_RV, QUOTE_L):  # no contraction: the letter before starts a word
                before_previous = 1
                if c in _LETTERS:
                    here, to = 0, IN_LETTERS
            elif s in (ONE_BLANK, ONE_SPACE, RUN_BLANK, RUN_SPACE):
                if c in (BLANK, SPACE):
                    here, to = 0, RUN_BLANK if c == BLANK else RUN_SPACE
                else:  # the last of a longer run stands apart; a blank goes with the word
                    before_previous = int(s in (RUN_BLANK, RUN_SPACE))
                    if s in (ONE_BLANK, RUN_BLANK):
                        here, to = 0, enter(c, True)
            cell[s, c] = to * 4 + before_previous * 2 + here
    return cell


def _classes(path: str) -> np.ndarray:
    """Class of each code point.  The library may know a newer Unicode than
    Python, so it is asked about the code points that Python has no category for."""
    from tokenizers import Tokenizer
    table = np.full(0x110000, OTHER, np.uint8)
    unknown = []
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))
        if kind[0] == "L":
            table[i] = LETTER
        elif kind[0] == "N":
            table[i] = NUMBER
        elif kind == "Cn" and i < 0x40000:  # the planes above have no letters or numbers
            unknown.append(i)
    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    for mark, kind in (("a", LETTER), ("1", NUMBER)):
        at = 0
        for word, _ in split("".join(f" {mark}{chr(i)}" for i in unknown)):
            if word[0] == "\u0120":  # a new " mark", alone or with its code point
                if len(word) > 2:
                    table[unknown[at]] = kind
                at += 1
    for c in SPACE_CHARS:
        table[ord(c)] = SPACE
    table[ord(" ")], table[ord("'")], table[ord(SEP)] = BLANK, APOSTROPHE, END
    for letters, kind in (("stmd", STMD), ("rv", RV), ("l", EL), ("e", E)):
        for c in letters:
            table[ord(c)] = kind
    return table


def compose(maps: np.ndarray) -> np.ndarray:
    """Prefix compositions of state maps (chunks, states): row i maps the first chunk's start over chunks 0..i."""
    maps = maps.copy()
    step = 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], axis=1)
        step *= 2
    return maps


class WordStarts:
    """The word transducer, run over all chunks of a block at once."""

    def __init__(self, path: str):
        self.cell = _word_transducer().reshape(-1)
        self.kind = _classes(path)

    def run(self, chars: np.ndarray) -> np.ndarray:
        """Whether a word starts at each code point."""
        n = len(chars)
        lanes = -(-n // CHUNK)
        kinds = np.full(lanes * CHUNK, END, np.uint8)
        kinds[:n] = self.kind[chars]
        kinds = np.ascontiguousarray(kinds.reshape(lanes, CHUNK).T).astype(np.intp)
        # state maps: all starts at once, until they agree in every lane; most do within a word or two
        state = np.repeat(np.arange(11, dtype=np.intp)[:, None], lanes, axis=1)
        apart = np.arange(lanes)
        t, agreed = 0, np.zeros(lanes, np.int64)
        final = np.empty((lanes, 11), np.intp)
        live = state
        while t < CHUNK and len(apart):
            live = (self.cell[live * 11 + kinds[t, apart]] >> 2).astype(np.intp)
            t += 1
            if t % 8 == 0 or t == CHUNK:
                same = (live == live[0]).all(axis=0)
                done = same if t < CHUNK else np.ones(len(apart), bool)
                agreed[apart[done]] = t
                final[apart[done]] = live[:, done].T
                apart, live = apart[~done], live[:, ~done]
        # where all starts agree, one run gives the end of all
        s, out = final[:, 0].copy(), np.zeros((CHUNK, lanes), np.uint8)
        for t in range(int(agreed.min(initial=CHUNK)), CHUNK):
            go = agreed <= t
            c = self.cell[s * 11 + kinds[t]]
            out[t] = c
            s = np.where(go, c >> 2, s)
        maps = np.where((agreed < CHUNK)[:, None], s[:, None], final)
        ends = compose(maps)[:, FRESH]
        # the true start of each chunk; only what lies before its agreement is run again
        s = np.concatenate([[FRESH], ends[:-1]])
        for t in range(int(agreed.max(initial=0))):
            again = agreed > t
            c = self.cell[s * 11 + kinds[t]]
            out[t] = np.where(again, c, out[t])
            s = np.where(again, c >> 2, s)
        flat = out.T.reshape(-1)
        starts = (flat & 1).astype(bool)
        starts[:-1] |= (flat[1:] & 2).astype(bool)
        return starts[:n]


def byte_letters() -> dict[str, int]:
    """The vocabulary's printable letter of each byte, inverted (a fixed rule of byte-level BPE)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
