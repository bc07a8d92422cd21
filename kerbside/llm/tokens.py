"""Token ids of whole texts by a public tokenizer, through worker caches of text pieces.

A tokenizer that splits text before its merges gives a text the ids of its pieces one after the other, wherever the cut is
one that the split makes anyway. So a piece seen before costs a dictionary lookup, a new piece of plain letters goes to the
library's merge model, and any other piece or text goes through the whole library.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pieces that one worker remembers; at about 200 bytes each this bounds its memory.
CACHED_PIECES = 700_000
CACHED_BYTES = 64
# Pieces of ASCII and Latin-1 letters, digits and ASCII signs but the apostrophe: normalisation leaves them as they are, and
# split patterns part them into runs of letters, of digits and of signs.
PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]*")
CASED_RUNS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]+|[^A-Za-z0-9À-ÖØ-öø-ÿ]+")
LOWER_RUNS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself if it prints, else the next code from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in prints else next(spare)) for b in range(256)}


class Encoder(dict):
    """A cache from pieces (bytes) to values made of their ids, which add up; ``before`` stands before every piece.

    ``cased`` tells whether the tokenizer keeps capital letters. ``frequent`` holds values that are never forgotten. The cache
    starts anew when it is full; pieces of more than ``CACHED_BYTES`` are not kept.
    """

    def __init__(
        self,
        path: str,
        value: Callable[[list], bytes | int],
        cased: bool,
        before: str = "",
        frequent: dict[bytes, int] | None = None,
    ):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merged = self.tokenizer.model.tokenize
        self.value, self.cased, self.before = value, cased, before
        self.letters = byte_letters()
        self.before_letters = before.translate(self.letters)
        self.frequent = frequent or {}
        self.update(self.frequent)

    def whole(self, text: str) -> bytes | int:
        return self.value(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def start_anew(self) -> None:
        """Keep the frequent pieces only."""
        self.clear()
        self.update(self.frequent)

    def __missing__(self, piece: bytes) -> bytes | int:
        if len(self) >= CACHED_PIECES:
            self.start_anew()
        done = self.encoded(piece)
        if len(piece) <= CACHED_BYTES:
            self[piece] = done
        return done

    def encoded(self, piece: bytes) -> bytes | int:
        text = piece.decode()
        if piece.isalpha():  # one run of ASCII letters, which are written as they are
            return self.value(self.merged(self.before_letters + (text if self.cased else text.lower())))
        if not piece or b"<|" in piece or not PLAIN.fullmatch(text):
            return self.whole(self.before + text)
        runs = CASED_RUNS.findall(text) if self.cased else LOWER_RUNS.findall(text.lower())
        if len(runs) > 1 and not self.before:  # a word with a comma has the ids of the word and of the comma
            return reduce(add, [self[run.encode()] for run in runs])
        runs[0] = self.before + runs[0]
        return self.value([t for run in runs for t in self.merged(run.encode().decode("latin-1").translate(self.letters))])


def ids_as_bytes(tokens: list) -> bytes:
    """Little-endian unsigned 32-bit ids, of ids or of the merge model's tokens."""
    return array("I", tokens if not tokens or isinstance(tokens[0], int) else [t.id for t in tokens]).tobytes()


def ids_of_words(encoder: Encoder, text: bytes) -> bytes:
    """Ids by a tokenizer that lowers case and drops white space: every cut at ASCII white space is certain."""
    if b"<|" in text:
        return encoder.whole(text.decode())
    return b"".join(map(encoder.__getitem__, text.lower().split()))


def ids_of_texts(encoder: Encoder, texts: list[bytes]) -> list[bytes]:
    """``ids_of_words`` of each text; a word is looked up once for all of them, however often they have it."""
    own = pa.array([b"" if b"<|" in x else x.lower() for x in texts], pa.large_binary())
    words = pc.ascii_split_whitespace(own.view(pa.large_string()))
    found = words.flatten().dictionary_encode()
    different = found.dictionary.view(pa.large_binary()).to_pylist()
    # White space at either end of a text gives an empty word.
    ids = pa.array([encoder[x] if x else b"" for x in different], pa.large_binary()).take(found.indices)
    if not len(ids):
        return [encoder.whole(x.decode()) if b"<|" in x else b"" for x in texts]
    _, bounds, data = ids.buffers()
    data = data.to_pybytes() if data else b""
    ends = np.frombuffer(bounds, np.int64)[words.offsets.to_numpy()].tolist()
    parts = [data[a:b] for a, b in zip(ends, ends[1:])]
    return [encoder.whole(x.decode()) if b"<|" in x else part for x, part in zip(texts, parts)]


# Before one space alone, and before several that follow a sign or letter of ASCII.
_CUTS = re.compile(rb"(?<! )(?= (?! ))|(?<=[!-~])(?=  )")


def spaced_pieces(text: bytes) -> list[bytes]:
    """The text in pieces: the first as it is, the others without the one space that each begins with.

    A byte-level tokenizer that ties one space to the word after it cuts at all these places, whatever stands around them;
    runs of spaces stay whole. Special strings have no space, so they stay whole too.
    """
    if b"  " not in text:
        return text.split(b" ")
    first, *others = _CUTS.split(text)
    return [first, *[x[1:] for x in others]]


def count_of_spaced(encoder: Encoder, text: bytes) -> int:
    """Number of ids by a byte-level tokenizer that ties one space to the word after it."""
    pieces = spaced_pieces(text)
    return encoder.whole(pieces[0].decode()) + sum(map(encoder.__getitem__, pieces[1:]))


_ENCODERS: dict[str, Encoder] = {}


def word_encoder(path: str) -> Encoder:
    """This worker's encoder to ids as bytes."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, ids_as_bytes, cased=False)
    return _ENCODERS[path]
