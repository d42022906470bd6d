"""Whole texts to token ids, many texts in one call.

The tokenizer cuts a text into pieces (runs of letters, single digits, runs of signs)
and merges the bytes of each. Texts of plain Latin letters are lowered and cut for a
whole block at once, on its bytes, and a byte-pair encoder that holds the same
vocabulary merges all pieces in one call. Any other text is split at white space,
where the tokenizer never merges, and its words are encoded once per worker: plain
ones as above, the rest by the tokenizer itself.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Words remembered by a worker (some 250 bytes each) before it starts afresh.
REMEMBERED = 250_000

#: Stands for the end of a word among the bytes; words that hold it are not plain.
END = "\x01"
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# Fixed value: how the tokenizer cuts a word, for plain words.
CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: Characters that split() takes for white space and the tokenizer doesn't.
SEPARATORS = "\x1c\x1d\x1e\x1f"
SPACE = re.compile(r"[ \t\n\v\f\r]+")

BLANK, LETTER, DIGIT, SIGN, OTHER = range(5)
#: First byte of the Latin letters beyond ASCII that plain texts may have (À to ÿ).
LATIN = 0xC3


def _kinds() -> np.ndarray:
    """What each byte of a lowered plain text is part of."""
    out = np.full(256, OTHER, np.uint8)
    out[0x21:0x7F] = SIGN
    out[list(b" \t\n\v\f\r")] = BLANK
    out[ord("0") : ord("9") + 1] = DIGIT
    out[ord("a") : ord("z") + 1] = LETTER
    out[ord("A") : ord("Z") + 1] = LETTER
    out[0x80:0xC0] = out[LATIN] = LETTER
    return out


KIND = _kinds()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def _byte_of() -> dict[str, int]:
    """The byte that each printable stand-in of a byte-level vocabulary means."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordEncoder:
    """Ids of a lower-casing byte-pair tokenizer that marks the ends of words."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        suffix, byte_of = model["end_of_word_suffix"], _byte_of()

        def raw(token: str) -> bytes:
            body = token.removesuffix(suffix)
            return bytes(byte_of[c] for c in body) + END.encode() * (body != token)

        # A lone byte, then a byte with the end mark, then the merges by rank.
        order = [bytes([b]) for b in range(256)] + [bytes([b]) + END.encode() for b in range(256)]
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            order.append(raw(left + right))
        ranks: dict[bytes, int] = {}
        for token in order:
            ranks.setdefault(token, len(ranks))
        self.id_of = np.zeros(len(ranks), "<u4")
        for token, number in model["vocab"].items():
            if all(c in byte_of for c in token.removesuffix(suffix)):
                place = ranks.get(raw(token))
                if place is not None:
                    self.id_of[place] = number
        self.ends = np.zeros(len(ranks), bool)
        for token, place in ranks.items():
            self.ends[place] = token.endswith(END.encode()) and token != END.encode()
        self.encoder = tiktoken.Encoding(
            "words", pat_str=f"[^{END}]+{END}", mergeable_ranks=ranks, special_tokens={}
        )
        self.known: dict[str, bytes] = {}

    def _plain(self, words: list[str]) -> list[bytes]:
        cut = [CUT.findall(w.lower()) for w in words]
        parts = np.cumsum([len(c) for c in cut])
        joined = END.join(p for c in cut for p in c) + END
        places = np.array(self.encoder.encode_ordinary(joined), np.int64)
        stops = np.flatnonzero(self.ends[places]) + 1
        if len(stops) != parts[-1]:
            raise ValueError("a word's end got lost")
        raw, at = self.id_of[places].tobytes(), (stops[parts - 1] * 4).tolist()
        return [raw[i:j] for i, j in zip([0, *at], at, strict=False)]

    def learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        plain = [w for w in words if PLAIN.fullmatch(w) and "<|" not in w]
        if plain:
            self.known.update(zip(plain, self._plain(plain), strict=True))
        rest = list(words.difference(plain)) if len(plain) < len(words) else []
        for word, found in zip(
            rest, self.tokenizer.encode_batch(rest, add_special_tokens=False), strict=True
        ):
            self.known[word] = np.array(found.ids, "<u4").tobytes()

    def _cut_block(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lowered bytes with a mark after each piece, where pieces end, and odd bytes."""
        kind, low = KIND[raw], LOWER[raw]
        second = np.zeros(len(raw), bool)
        second[1:] = raw[:-1] == LATIN
        low[second & (raw >= 0x80) & (raw <= 0x9E)] += 32
        # Odd: beyond plain, a multiplication or division sign, half a character.
        odd = kind == OTHER
        odd |= (raw >= 0x80) & (raw < 0xC0) & ~second
        odd |= second & ((raw == 0x97) | (raw == 0xB7))
        ends = np.zeros(len(raw), bool)
        ends[:-1] = (kind[:-1] != kind[1:]) | (kind[:-1] == DIGIT)
        real = kind > 0
        ends &= real
        size = real.astype(np.int64) + ends
        place = np.cumsum(size) - size
        out = np.full(int(size.sum()), ord(END), np.uint8)
        out[place[real]] = low[real]
        return out, ends, odd

    def encode_block(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        plain = [t for t in texts if b"'" not in t and b"<|" not in t]
        found: dict[int, bytes] = {}
        if plain:
            raw = np.frombuffer(b"\n".join(plain) + b"\n", np.uint8)
            starts = np.cumsum([0, *(len(t) + 1 for t in plain)])
            marked, ends, odd = self._cut_block(raw)
            clean = np.add.reduceat(odd, starts[:-1], dtype=np.int64) == 0
            if not clean.all():
                plain = [t for t, c in zip(plain, clean.tolist(), strict=True) if c]
                raw = np.frombuffer(b"\n".join(plain) + b"\n", np.uint8)
                starts = np.cumsum([0, *(len(t) + 1 for t in plain)])
                marked, ends, _ = self._cut_block(raw)
            places = self.encoder.encode_to_numpy(marked.tobytes().decode(), disallowed_special=())
            stops = np.concatenate([[0], np.flatnonzero(self.ends[places]) + 1])
            pieces = np.concatenate([[0], np.cumsum(ends)])[starts]
            if len(stops) != pieces[-1] + 1:
                raise ValueError("a piece's end got lost")
            ids, at = self.id_of[places].tobytes(), (stops[pieces] * 4).tolist()
            found = {
                id(t): ids[i:j] for t, i, j in zip(plain, at[:-1], at[1:], strict=True)
            }
        rest = [t for t in texts if id(t) not in found]
        found |= {id(t): r for t, r in zip(rest, self._by_word([t.decode() for t in rest]), strict=True)}
        return [found[id(t)] for t in texts]

    def _by_word(self, texts: list[str]) -> list[bytes]:
        split = [
            SPACE.split(t) if any(c in t for c in SEPARATORS) else t.split() for t in texts
        ]
        every = set().union(*split)
        every.discard("")
        new = every.difference(self.known)
        if new:
            self.learn(new)
            if not every <= self.known.keys():  # it started afresh
                self.learn(every.difference(self.known))
        self.known[""] = b""
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker and file."""
    return WordEncoder(path)
