"""Packing documents into sequences along a Hilbert curve, so that neighbours in a sequence resemble each other.

Each document becomes a vector of hashed token counts, projected to a few dimensions and put at a point of a
Hilbert curve. Documents are range-sorted by their place on the curve and laid end to end; the stream is cut
every ``LENGTH`` ids. A document that crosses a cut goes on in the next sequence, so all sequences but the last are full.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivertally.llm.common import given_id, known_id
from rivertally.llm.order import running_total
from rivertally.session import durable

LENGTH = 2048
END_ID = 1
#: Entries of the hashed vector, dimensions of the curve and bits of each.
HASHED = 64
AXES = 3
AXIS_BITS = 10

# The characters that the vocabulary's \s matches. None of them is ever part of a token.
WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# The characters that str.split() takes for white space beyond those.
SPLIT_ONLY = re.compile(r"[\x1c-\x1f]")

#: Pieces of text whose ids one worker remembers, in each of two generations.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64
#: Stands between the pieces that the library is asked about in one text; one id of its own, as no other character has this byte.
MARK = "\0"
#: Marks that often stand right behind a word.
MARKS = frozenset(",.!?;:")
#: Pieces that the library is asked about in one text.
ASKED_AT_ONCE = 200
#: Characters of text whose new pieces are looked up together; a longer text is looked up by itself.
TOGETHER = 1 << 21


class Encoder:
    """Ids of whole texts by the ``tokenizers`` library, asked once for each distinct piece between white space.

    The vocabulary never joins characters across white space (its normaliser makes each run of it one space, and its
    splitter leaves spaces out), so the ids of a text are those of its pieces, one after the other. Pieces are asked about
    many at a time, with ``MARK`` between them where they aren't of letters alone. A piece that holds the mark or a special token's string is asked about by
    itself, and so is every piece where the vocabulary has no single id for the mark. Pieces not used for a generation are forgotten.
    """

    def __init__(self, path: str):
        # Tasks run side by side already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.type = np.uint16 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        normaliser = json.loads(self.library.to_str())["normalizer"]
        self.small = '"Lowercase"' in json.dumps(normaliser)
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items() if t.special}
        self.apart = re.compile("|".join(map(re.escape, [MARK, *self.special])))
        # Ids that end a word, if the vocabulary tells them by a suffix.
        suffix = json.loads(self.library.to_str())["model"].get("end_of_word_suffix")
        self.last = np.zeros(self.library.get_vocab_size(with_added_tokens=True), bool)
        if suffix:
            self.last[[i for token, i in self.library.get_vocab(with_added_tokens=False).items() if token.endswith(suffix)]] = True
        marked = self.library.encode(MARK, add_special_tokens=False).ids
        self.mark = marked[0] if len(marked) == 1 else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ask(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of different pieces. Those of letters alone need no mark: each is one word to the library, so its last id ends a word and no other does."""
        if not self.last.any():
            return self._ask_marked(pieces)
        words = [p for p in pieces if p.isalpha()]
        found, rest = {}, [p for p in pieces if not p.isalpha()]
        lots = [words[i : i + ASKED_AT_ONCE] for i in range(0, len(words), ASKED_AT_ONCE)]
        width = np.dtype(self.type).itemsize
        for lot, e in zip(lots, self.library.encode_batch_fast([*map(" ".join, lots)], add_special_tokens=False), strict=True):
            ids = np.asarray(e.ids, self.type)
            ends = ((np.flatnonzero(self.last[ids]) + 1) * width).tolist()
            if len(ends) != len(lot):  # some letter became a letter and something else
                rest += lot
                continue
            data = ids.tobytes()
            found.update(zip(lot, map(data.__getitem__, map(slice, [0, *ends], ends)), strict=True))
        return found | self._ask_marked(rest)

    def _ask_marked(self, pieces: list[str]) -> dict[str, bytes]:
        alone = [p for p in pieces if self.mark is None or self.apart.search(p)]
        found = dict(zip(alone, (np.asarray(e.ids, self.type).tobytes() for e in self.library.encode_batch_fast(alone, add_special_tokens=False)), strict=True))
        others = [p for p in pieces if p not in found] if alone else pieces
        if others:
            lots = [others[i : i + ASKED_AT_ONCE] for i in range(0, len(others), ASKED_AT_ONCE)]
            width = np.dtype(self.type).itemsize
            for lot, e in zip(lots, self.library.encode_batch_fast([f" {MARK} ".join(lot) for lot in lots], add_special_tokens=False), strict=True):
                ids = np.asarray(e.ids, self.type)
                ends = (np.append(np.flatnonzero(ids == self.mark), len(ids)) * width).tolist()
                data, start = ids.tobytes(), 0
                for piece, end in zip(lot, ends, strict=True):
                    found[piece] = data[start:end]
                    start = end + width
        return found

    def _cut(self, text: str) -> list[str]:
        if self.small and text.isascii() and not any(s in text.lower() for s in self.special):
            text = text.lower()  # what the library would make of it; capitals then need no entries of their own
        return [p for p in WHITE.split(text) if p] if SPLIT_ONLY.search(text) else text.split()

    def _learned(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of pieces that aren't among the young ones, and of the parts that they were asked about in."""
        known = {p: b for p in pieces if (b := self.old.get(p)) is not None} if self.old else {}
        # Most pieces stand for themselves; what isn't small or has a mark behind it may not.
        parts = {p: _parts(p, self.small) for p in pieces if (p[-1] in MARKS or not p.islower()) and p not in known}
        simple = {q for own in parts.values() for q in own}
        simple.update(p for p in pieces if p not in parts and p not in known)
        held = {q: b for q in simple if (b := self.young.get(q) or self.old.get(q)) is not None}
        held |= self._ask([q for q in simple if q not in held])
        return known | held | {p: b"".join(map(held.__getitem__, own)) for p, own in parts.items()}

    def many(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text. The library is asked about the new pieces of some ``TOGETHER`` characters at once."""
        lot, size = [], 0
        for text in texts:
            lot.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self._together(lot)
                lot, size = [], 0
        yield from self._together(lot)

    def _together(self, texts: list[str]) -> list[np.ndarray]:
        cut = [*map(self._cut, texts)]
        learned = self._learned(set().union(*cut).difference(self.young))
        self.young.update(learned)
        young = self.young
        ids = [np.frombuffer(b"".join(map(young.__getitem__, pieces)), self.type) for pieces in cut]
        for piece in learned:
            if len(piece) > LONGEST_REMEMBERED:
                young.pop(piece, None)
        if len(young) > REMEMBERED:
            self.old, self.young = young, {}
        return ids

    def ids(self, text: str) -> np.ndarray:
        return self._together([text])[0]


def _ends_in_a_letter(word: str) -> bool:
    """Whether a word still ends in a letter once it is normalised: some letters become a letter and a mark, which the library then reads together
    with the punctuation behind it."""
    return all(unicodedata.category(form[-1])[0] == "L" for form in (unicodedata.normalize("NFC", word), unicodedata.normalize("NFC", word.lower())))


def _parts(piece: str, small: bool) -> tuple[str, ...]:
    """What a piece has the same ids as: a word and the mark after it stand for themselves, and ASCII capitals for small
    letters if the vocabulary makes letters ``small``."""
    word, mark = (piece[:-1], piece[-1:]) if piece[-1] in MARKS else (piece, "")
    if not word.isalpha() or not (word.isascii() or (mark and _ends_in_a_letter(word))):
        return (piece,)
    word = word.lower() if small and word.isascii() else word
    return (word, mark) if mark else (word,)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _hash_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry and sign of each id's hash, and the projection; the same on every worker."""
    ids = np.arange(1 << 16, dtype=np.uint64)
    h = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    projection = np.random.default_rng(5).standard_normal((HASHED, AXES)) / np.sqrt(HASHED)
    return (h >> np.uint64(8)).astype(np.int64) % HASHED, np.where(h & np.uint64(1), 1.0, -1.0), projection


def curve_key(points: np.ndarray, bits: int = AXIS_BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with integer coordinates below ``2 ** bits``, one row per point.

    The coordinates are turned into the curve's own axes bit by bit, from the highest bit down (exchange
    and inversion of the lower bits, then Gray decoding), and their bits are interleaved.
    """
    x = points.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(axes):
            on = (x[i] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(turn)
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def _encoded(batches: Iterator[pa.RecordBatch], path: str, carried: tuple[str, ...] = ()) -> Iterator[pa.RecordBatch]:
    """Ids, their number and the curve key of every document, beside the ``carried`` columns."""
    ask = encoder(path)
    entry, sign, projection = _hash_tables()
    for batch in batches:
        ids = [np.append(own, ask.type(END_ID)) for own in ask.many(t.as_py() for t in batch["text"])]
        vectors = np.zeros((len(ids), HASHED))
        for v, own in zip(vectors, ids, strict=True):
            low = own & 0xFFFF
            v += np.bincount(entry[low], weights=sign[low], minlength=HASHED)
        norm = np.linalg.norm(vectors, axis=1, keepdims=True)
        flat = vectors / np.where(norm > 0, norm, 1) @ projection
        # A projected coordinate is close to normal with deviation 1 / sqrt(HASHED): four of them fill the axis.
        scaled = np.clip((flat * np.sqrt(HASHED) / 8 + 0.5) * (1 << AXIS_BITS), 0, (1 << AXIS_BITS) - 1)
        yield pa.RecordBatch.from_arrays(
            [
                batch["did"],
                batch["th"],
                pa.array([x.tobytes() for x in ids], pa.binary()),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array(curve_key(scaled), pa.int64()),
                *(batch[c] for c in carried),
            ],
            ["did", "th", "ids", "n", "key", *carried],
        )


def _pieces(batches: Iterator[pa.RecordBatch], length: int, kind: type) -> Iterator[pa.RecordBatch]:
    """Cut each document where its place in the stream says, and digest the ids of every piece."""
    names = ["did", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for batch in batches:
        rows = []
        for did, ids, place in zip(batch["did"].to_pylist(), batch["ids"], batch["place"].to_pylist(), strict=True):
            own = np.frombuffer(ids.as_buffer(), kind).astype("<u4")
            at = 0
            while at < len(own):
                sequence, offset = divmod(place + at, length)
                piece = own[at : at + length - offset]
                rows.append((did, at, len(piece), zlib.crc32(piece.tobytes()), len(own), sequence, offset))
                at += len(piece)
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def in_files(docs: DataFrame) -> DataFrame:
    """``docs`` as the table that it was read from, or written to one in its order: files by name, rows by number."""
    try:
        docs.select("_metadata.row_index")
        return docs
    except AnalysisException:
        return durable(docs)


def pack(docs: DataFrame, path: str, length: int = LENGTH, stretch: int | None = None) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``path`` is a vocabulary for the ``tokenizers`` library, the same on all machines. A missing or empty text is the
    end id alone. Repeated rows are packed each by itself; rows with a missing ``doc_id`` come back with a missing one. An empty
    table gives no piece. Equal places on the curve stand in order of identifier and text hash.

    With ``stretch`` the order of the table (see ``in_files``) is kept: so many rows at a time are laid along the curve, and the stretches follow each other.
    """
    docs = docs if stretch is None else in_files(docs)
    text = F.coalesce(docs["text"], F.lit(""))
    at = {} if stretch is None else {"file": F.col("_metadata.file_name"), "stretch": F.expr(f"_metadata.row_index div {stretch}")}
    rows = docs.select(known_id("doc_id").alias("did"), F.xxhash64(text).alias("th"), text.alias("text"), *[c.alias(n) for n, c in at.items()])
    schema = "did long, th long, ids binary, n long, key long" + (", file string, stretch long" if at else "")
    encoded = durable(rows.mapInArrow(partial(_encoded, path=path, carried=tuple(at)), schema))
    # Repeated rows need places of their own: the file and position tell them apart, and are read again the same.
    named = encoded.select("did", "th", "n", "key", "ids", *at, F.struct("_metadata.file_name", "_metadata.row_index").alias("row"))
    placed = running_total(named.select("did", "th", "n", "key", "row", *at), [], [*at, "key", "did", "th"], "n", "place")
    stream = named.select("row", "did", "ids").join(placed.select("row", "place"), "row").select("did", "ids", "place")
    cut = stream.mapInArrow(
        partial(_pieces, length=length, kind=encoder(path).type),
        "did long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
    return cut.select(given_id("did").alias("doc_id"), *cut.columns[1:])
