"""Token counts by a finite-state transducer that is compiled from a byte-pair vocabulary.

Within a word, the encoding of a prefix ends in exactly one token: the suffix token that fits the one before it, where
two tokens fit if the merges leave them apart. So the prefixes of words are the states of a deterministic
transducer over symbols (bytes, and bytes at a word's end), and a transition carries the number of tokens by which the
encoding grows or shrinks. States are made when a text first needs them, up to a bound on depth and number.

White space ends every word, so it brings the transducer back to its start from any state. A chunk of text is
thus a map from states to states with three parts: what it reads before its first white space, the count
up to its last, and what it reads after. Such maps compose associatively. Texts longer than a chunk are
cut over tasks and their maps composed in order.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import partial, reduce

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivertally.llm.common import given_id, known_id
from rivertally.llm.packing import SPLIT_ONLY, WHITE

LIMIT = 2048
CHUNK = 1 << 16
# Small letters that Unicode 16 added for capitals that Python may not know yet.
NEWER_SMALL = {0xA7CB: 0x0264, 0xA7DC: 0x019B}
#: States that one worker keeps, and pieces whose count it remembers in each of two generations; beyond that it starts anew.
MOST_STATES = 400_000
MOST_PIECES = 250_000
LONGEST_KEPT = 64
#: States lie at most so deep; beyond it a word is read on without making any.
DEEPEST = 48


def byte_names() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Transducer:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        end, vocab = model["end_of_word_suffix"] or "", model["vocab"]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        added = [t["content"] for t in spec["added_tokens"]]
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        names = byte_names()
        self.inner, self.last = [vocab[c] for c in names], [vocab[c + end] for c in names]
        # Symbols and merges by number: 0 to 511 for the symbols, then the merges in order of rank.
        number = {t: i for i, t in enumerate((*self.inner, *self.last))}
        self.inner, self.last = list(range(256)), list(range(256, 512))
        self.halves: list[tuple[int, int]] = [(i, i) for i in range(512)]
        self.merged: dict[tuple[int, int], int] = {}
        symbols: list[tuple[int, ...]] = [(i,) for i in range(512)]
        for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            left, right, token = number[vocab[a]], number[vocab[b]], vocab[a + b]
            if token not in number:
                number[token] = len(symbols)
                symbols.append(symbols[left] + symbols[right])
                self.halves.append((left, right))
            self.merged.setdefault((left, right), number[token])
        # Tokens by their symbols, read backwards. A token that the merges never leave whole ends nothing.
        self.backwards: dict = {}
        for token, own in enumerate(symbols):
            if token < 512 or self.encode(own) == [token]:
                node = self.backwards
                for s in reversed(own):
                    node = node.setdefault(s, {})
                node[-1] = token
        self.restart()

    def restart(self) -> None:
        """Forget all states. State 0 is the start of a word."""
        self.moves: dict[int, int] = {}
        self.symbol, self.token, self.tokens, self.before, self.depth = [-1], [-1], [0], [-1], [0]
        self.fits: dict[tuple[int, int], bool] = {}
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def encode(self, symbols: Iterable[int]) -> list[int]:
        """The merges applied one after the other, lowest rank first."""
        out = list(symbols)
        while True:
            best, at = None, 0
            for i, pair in enumerate(zip(out, out[1:])):
                token = self.merged.get(pair)
                if token is not None and (best is None or token < best):
                    best, at = token, i
            if best is None:
                return out
            out[at : at + 2] = [best]

    def _fit(self, a: int, b: int) -> bool:
        """Do the merges leave these tokens apart? Their merges are undone from the last one back: at every step, a merge
        across the border that comes before the one undone last would have been made."""
        key = (a, b)
        known = self.fits.get(key)
        if known is None:
            known, undone = True, 1 << 62
            while True:
                across = self.merged.get((a, b))
                # On equal rank the pair further left goes first.
                if across is not None and across < undone:
                    known = False
                    break
                if a < 512 and b < 512:
                    break
                if a > b:
                    undone, a = a, self.halves[a][1]
                else:
                    undone, b = b + 1, self.halves[b][0]
            if len(self.fits) > 4 * MOST_STATES:
                self.fits.clear()
            self.fits[key] = known
        return known

    def _last_token(self, symbol: int, back: Iterable[tuple[int, int, int]]) -> tuple[int, int]:
        """The token that ends at ``symbol`` and the number of tokens up to it. ``back`` gives symbol, last token and number
        of tokens of the prefixes before, from the longest down to the empty one (symbol -1)."""
        node, found = self.backwards[symbol], []
        for s, token, tokens in back:
            if -1 in node:
                found.append((node[-1], token, tokens))
            if s not in node:
                break
            node = node[s]
        for own, token, tokens in reversed(found):
            if token < 0 or self._fit(token, own):
                return own, tokens + 1
        raise ValueError("no token fits: the vocabulary's merges are not in rank order")

    def _prefixes(self, state: int) -> Iterator[tuple[int, int, int]]:
        while state >= 0:
            yield self.symbol[state], self.token[state], self.tokens[state]
            state = self.before[state]

    def _move(self, state: int, symbol: int) -> int:
        token, tokens = self._last_token(symbol, self._prefixes(state))
        to = self.moves[state << 9 | symbol] = len(self.symbol)
        self.symbol.append(symbol)
        self.token.append(token)
        self.tokens.append(tokens)
        self.before.append(state)
        self.depth.append(self.depth[state] + 1)
        return to

    def _long_word(self, symbols: list[int]) -> int:
        """The same transitions without states: a list of the prefixes so far, longest last."""
        seen = [(-1, -1, 0)]
        for s in symbols:
            seen.append((s, *self._last_token(s, reversed(seen))))
        return seen[-1][2]

    def word(self, data: bytes) -> int:
        """Tokens of one word: what its transitions emit, summed up in its last state."""
        symbols = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        if len(symbols) > DEEPEST:
            return self._long_word(symbols)
        state, moves = 0, self.moves
        for s in symbols:
            to = moves.get(state << 9 | s)
            state = self._move(state, s) if to is None else to
        return self.tokens[state]

    def _plain(self, text: str) -> int:
        text = unicodedata.normalize("NFC", text)
        # Letters become small one by one, whatever stands beside them.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        text = text if text.isascii() else text.translate(NEWER_SMALL)
        return sum(self.word(w.encode()) for w in self.words.findall(text))

    def piece(self, piece: str) -> int:
        """Tokens of a piece of text without white space. A special token's string in it is that token."""
        known = self.young.get(piece)
        if known is None:
            known = self.old.get(piece)
            if known is None:
                if len(self.symbol) > MOST_STATES:
                    young, old = self.young, self.old
                    self.restart()
                    self.young, self.old = young, old
                special = self.added.findall(piece) if self.added else []
                known = len(special) + sum(map(self._plain, self.added.split(piece) if special else [piece]))
            if len(piece) <= LONGEST_KEPT:
                self.young[piece] = known
                if len(self.young) > MOST_PIECES:
                    self.old, self.young = self.young, {}
        return known

    def count(self, text: str) -> int:
        pieces = [p for p in WHITE.split(text) if p] if SPLIT_ONLY.search(text) else text.split()
        counts = [*map(self.young.get, pieces)]
        if None in counts:
            counts = [self.piece(p) if n is None else n for p, n in zip(pieces, counts, strict=True)]
        return sum(counts)

    # Chunk maps: (before the first white space, count, after the last white space, is there any).
    def chunk(self, text: str) -> tuple[str, int, str, bool]:
        first = WHITE.search(text)
        if first is None:
            return text, 0, "", False
        stop = len(text)
        while not WHITE.match(text, stop - 1):
            stop -= 1
        return text[: first.start()], self.count(text[first.start() : stop]), text[stop:], True

    def compose(self, x: tuple[str, int, str, bool], y: tuple[str, int, str, bool]) -> tuple[str, int, str, bool]:
        if not x[3]:
            return x[0] + y[0], y[1], y[2], y[3]
        if not y[3]:
            return x[0], x[1], x[2] + y[0], True
        return x[0], x[1] + self.count(x[2] + y[0]) + y[1], y[2], True

    def total(self, maps: Iterable[tuple[str, int, str, bool]]) -> int:
        head, count, tail, _ = reduce(self.compose, maps)
        return self.count(head) + count + self.count(tail)


_compiled: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per worker process."""
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def _short(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    t = transducer(path)
    for batch in batches:
        n = [t.total([t.chunk(x)]) for x in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["did"], batch["n_bytes"], pa.array(n, pa.int64())], ["did", "n_bytes", "n_tokens"])


def _maps(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    t = transducer(path)
    for batch in batches:
        columns = list(zip(*map(t.chunk, batch["text"].to_pylist()), strict=True)) or [[]] * 4
        made = [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.bool_()), strict=True)]
        names = ["row", "did", "n_bytes", "no", "head", "count", "tail", "met"]
        yield pa.RecordBatch.from_arrays([batch["row"], batch["did"], batch["n_bytes"], batch["no"], *made], names)


def _composed(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    t = transducer(path)
    for batch in batches:
        n = [t.total((m["head"], m["count"], m["tail"], m["met"]) for m in maps) for maps in batch["maps"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["did"], batch["n_bytes"], pa.array(n, pa.int64())], ["did", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, path: str, chunk: int = CHUNK, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of every row.

    ``path`` is a byte-pair vocabulary file with word ends, the same on all machines. A missing or empty text has no tokens.
    Rows with a missing ``doc_id`` and repeated rows are counted each by itself. Other columns are not read.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(known_id("doc_id").alias("did"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    out = "did long, n_bytes long, n_tokens long"
    short = rows.where(F.length("text") <= chunk).mapInArrow(partial(_short, path=path), out)
    long = rows.withColumn("row", F.monotonically_increasing_id()).where(F.length("text") > chunk)
    parts = long.select("row", "did", "n_bytes", "text", F.explode(F.sequence(F.lit(0), F.expr(f"(length(text) - 1) div {chunk}"))).alias("no"))
    parts = parts.withColumn("text", F.substring("text", F.col("no") * chunk + 1, F.lit(chunk))).repartition("row", "no")
    maps = parts.select("row", "did", "n_bytes", F.col("no").cast("long").alias("no"), "text").mapInArrow(
        partial(_maps, path=path), "row long, did long, n_bytes long, no long, head string, count long, tail string, met boolean"
    )
    # One entry per chunk of one text.
    ordered = maps.groupBy("row", "did", "n_bytes").agg(F.sort_array(F.collect_list(F.struct("no", "head", "count", "tail", "met"))).alias("maps"))
    counted = short.union(ordered.select("did", "n_bytes", "maps").mapInArrow(partial(_composed, path=path), out))
    return counted.select(given_id("did").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
