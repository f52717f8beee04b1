"""Token counts of documents by byte-pair merging on a heap and a linked list; no ids are made."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from assayer.llm.common import small_batches
from assayer.llm.packing import Encoder, default_tokenizer

LIMIT = 2048
#: Cached runs of characters, in two generations; longer runs are counted each time.
CACHED, CACHED_CHARS = 500_000, 100
#: Characters of a text that are split at once, up to the next white space.
SLICE = 1 << 20


class Merges:
    """Byte-pair merges with their ranks, and how many of them a sequence of symbols undergoes."""

    def __init__(self, pairs: Sequence[Sequence[str]]):
        self.ranks = {(left, right): rank for rank, (left, right) in enumerate(pairs)}

    def count(self, symbols: list[str]) -> int:
        """Merges until no adjacent pair has a rank.

        Symbols are a doubly linked list by place; the heap has (rank, place of the left symbol, its pair). The lowest rank is
        merged first, of equal ones the leftmost. An entry whose pair has since changed is passed over.
        """
        n, rank_of = len(symbols), self.ranks.get
        pairs = list(zip(symbols, symbols[1:], strict=False))
        heap = [(rank, at, pairs[at]) for at, rank in enumerate(map(rank_of, pairs)) if rank is not None]
        if not heap:
            return 0
        heapify(heap)
        held: list[str | None] = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merged = 0
        while heap:
            _, at, pair = heappop(heap)
            follower = after[at]
            if follower >= n or held[at] != pair[0] or held[follower] != pair[1]:
                continue
            held[at], held[follower] = pair[0] + pair[1], None
            after[at] = behind = after[follower]
            merged += 1
            if behind < n:
                before[behind] = at
                rank = rank_of(new := (held[at], held[behind]))
                if rank is not None:
                    heappush(heap, (rank, at, new))
            front = before[at]
            if front >= 0:
                rank = rank_of(new := (held[front], held[at]))
                if rank is not None:
                    heappush(heap, (rank, front, new))
        return merged


class _Runs(dict):
    """Tokens of runs of characters. Two generations, so that what is often seen stays."""

    def __init__(self, count):
        super().__init__()
        self.count, self.old = count, {}

    def __missing__(self, run: str) -> int:
        tokens = self.old.get(run)
        if tokens is None:
            tokens = self.count(run)
        if len(run) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[run] = tokens
        return tokens


class TokenCounter:
    """Number of tokens that a tokenizer of lower-casing, white-space-dropping byte-level BPE gives for a text.

    Special tokens' strings in a text are one token each, as the library does by default. Its normaliser and splitter work within
    runs of non-space characters, so a run's tokens are counted once and remembered. Plain Latin text is lower-cased and split at
    white space at once; other runs go through the library's normaliser and splitter.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Merges([m.split(" ") if isinstance(m, str) else m for m in model["merges"]])
        self.suffix = model.get("end_of_word_suffix") or ""
        self.chars = Encoder.byte_chars()
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if odd or not {c + s for c in self.chars.values() for s in ("", self.suffix)} <= model["vocab"].keys():
            raise ValueError(f"{path}: not a byte-level BPE whose tokens are symbols less merges ({odd})")
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.plain, self.other = _Runs(self._plain_run), _Runs(self._other_run)

    def _symbols(self, symbols: list[str]) -> int:
        symbols[-1] += self.suffix
        return len(symbols) - self.merges.count(symbols)

    def _plain_run(self, run: str) -> int:
        """A run of lower-cased plain Latin; mostly a word, or a word and a stop."""
        if run.isalpha():
            return self._piece(run)
        if run[:-1].isalpha():
            return self.plain[run[:-1]] + self._piece(run[-1])
        return sum(map(self._piece, Encoder.PIECES.findall(run)))

    def _piece(self, piece: str) -> int:
        return self._symbols(list(piece) if piece.isascii() and piece.isprintable() else [self.chars[b] for b in piece.encode()])

    def _other_run(self, run: str) -> int:
        if Encoder.is_plain(run):
            return self.plain[run.lower()]
        tokens, at = 0, 0
        for found in self.special.finditer(run):
            tokens, at = tokens + 1 + self._normalised(run[at : found.start()]), found.end()
        return tokens + self._normalised(run[at:])

    def _normalised(self, text: str) -> int:
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        return sum(self._symbols(list(piece)) for piece, _ in pieces)

    def _slice(self, text: str) -> int:
        if not Encoder.is_plain(text):
            return sum(map(self.other.__getitem__, Encoder.RUNS.findall(text)))
        return sum(map(self.plain.__getitem__, text.lower().split()))

    def __call__(self, text: str) -> int:
        if len(text) <= SLICE:
            return self._slice(text)
        tokens, at = 0, 0
        while at < len(text):
            space = Encoder.SPACE.search(text, at + SLICE)
            end = space.start() if space else len(text)
            tokens, at = tokens + self._slice(text[at:end]), end
        return tokens


@lru_cache(maxsize=2)
def token_counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def counted(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (of the text in UTF-8), n_tokens and over_limit (n_tokens > limit) of every row of `docs` (doc_id, text).

    `tokenizer`: the file of a byte-level BPE for the tokenizers library; tokens are those of the whole text without added ones. A
    null text is an empty one and has none. Repeated rows and null doc_ids have their rows; of other columns nothing is read;
    an empty table gives no rows.

    Each task counts its own rows: nothing is shuffled, and a lost task is repeated alone. A task holds a few texts and
    up to a million remembered runs of at most 100 characters.
    """
    path = tokenizer or default_tokenizer()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_counter(path)
        for batch in small_batches(batches):
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            found = pa.array([tokens(texts[i].as_py() or "") for i in range(len(texts))], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, found], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", "text")
    counts = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_tokens")]
    counted_rows = rows.mapInArrow(count, T.StructType([rows.schema["doc_id"], *counts]))
    return counted_rows.withColumn("over_limit", F.col("n_tokens") > limit)
