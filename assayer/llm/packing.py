"""Packing of documents into token windows by order-preserving dynamic programming."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assayer.llm.common import small_batches

WINDOW = 2048
END_ID = 1
#: Cost of a cut, in tokens of padding: within a document after a sentence, and within a sentence.
SENTENCE_CUT = 8
HARD_CUT = 64
#: Sentences of more than this share of a window may be cut inside, every so many tokens.
LONG_SENTENCE = 4
HARD_STEP = 64
#: Tokens that one run of the dynamic programme holds; the window it leaves open begins the next run.
BLOCK = 1 << 19
#: Cached pieces, and runs of pieces between white space, in two generations each; longer runs are split each time.
CACHED, CACHED_CHARS = 150_000, 100
#: Characters of a text that are split at once, up to the next white space.
SLICE = 1 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Remembered(dict):
    """Ids of texts as `encode` gives them. Two generations, so that what is often seen stays; long texts are encoded each time."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.old.get(text)
        if ids is None:
            ids = self.encode(text)
        if len(text) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[text] = ids
        return ids


class Encoder:
    """Token ids of texts by a lower-casing, white-space-dropping BPE tokenizer, as little-endian 32-bit integers.

    The tokenizer's normaliser and splitter work within runs of non-space characters, so equal runs have equal ids and each
    distinct run is encoded once. Plain Latin text is lower-cased and split at white space at once, and a new run by the
    tokenizer's own pattern; a run with any other character, or with what may be a special token, goes through the whole tokenizer.
    """

    #: The tokenizer's split pattern, a fixed value.
    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    #: Beyond ASCII and the Latin letters that lower-casing and composition leave in one piece; separators that engines see differently.
    OTHER = re.compile("[^\x00-\x1b\x20-įı-ſ]|<\\|")
    RUNS = re.compile("[^\x20\x09-\x0d]+")
    SPACE = re.compile("[\x20\x09-\x0d]")

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.chars = self.byte_chars()
        self.pieces = _Remembered(self._piece)
        self.plain, self.other = _Remembered(self._plain_run), _Remembered(self._other_run)

    @staticmethod
    def byte_chars() -> dict[int, str]:
        """The character that stands for each byte: printable ones for themselves, the others from 256 on."""
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}

    def _piece(self, piece: str) -> bytes:
        symbols = piece if piece.isascii() and piece.isprintable() else "".join(map(self.chars.__getitem__, piece.encode()))
        ids = [t.id for t in self.model.tokenize(symbols)]
        return pack(f"<{len(ids)}I", *ids)

    def _plain_run(self, run: str) -> bytes:
        """Ids of a run of lower-cased plain Latin; mostly a word, or a word and a stop."""
        if run.isalpha():
            return self._piece(run)
        if run[:-1].isalpha():
            return self.plain[run[:-1]] + self.pieces[run[-1]]
        return b"".join(map(self.pieces.__getitem__, self.PIECES.findall(run)))

    def _other_run(self, run: str) -> bytes:
        if self.is_plain(run):
            return self.plain[run.lower()]
        return np.array(self.tokenizer.encode(run, add_special_tokens=False).ids, "<u4").tobytes()

    @classmethod
    def is_plain(cls, text: str) -> bool:
        if text.isascii():  # told at once, without a search
            return not ("<|" in text or "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text)
        return not cls.OTHER.search(text)

    def _slice(self, text: str) -> bytes:
        if not self.is_plain(text):
            return b"".join(map(self.other.__getitem__, self.RUNS.findall(text)))
        return b"".join(map(self.plain.__getitem__, text.lower().split()))

    def __call__(self, text: str) -> bytes:
        if len(text) <= SLICE:
            return self._slice(text)
        out, at = [], 0
        while at < len(text):
            space = self.SPACE.search(text, at + SLICE)
            end = space.start() if space else len(text)
            out.append(self._slice(text[at:end]))
            at = end
        return b"".join(out)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=2)
def sentence_ends(path: str) -> np.ndarray:
    """For each id, whether its token ends a sentence: a stop, perhaps with closing quotes or brackets, at a word's end."""
    tokenizer = encoder(path).tokenizer
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, i in tokenizer.get_vocab().items():
        if token.endswith("</w>"):
            ends[i] = token[:-4].rstrip("\"')]}").endswith((".", "!", "?"))
    return ends


def cut_points(lengths: Sequence[int], ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in a run of documents where a window may be cut, ascending from 0, and what a cut there costs.

    `lengths` are the documents' tokens, `ends` the places just after a sentence.
    """
    docs = np.cumsum(np.asarray(lengths, np.int64))
    places = np.union1d(np.concatenate([[0], docs]), ends)
    cost = np.full(len(places), SENTENCE_CUT, np.int64)
    cost[np.isin(places, docs) | (places == 0)] = 0
    gaps = np.flatnonzero(np.diff(places) > window // LONG_SENTENCE)
    if len(gaps):
        step = max(1, min(HARD_STEP, window // LONG_SENTENCE))
        hard = np.concatenate([np.arange(places[i] + step, places[i + 1], step) for i in gaps])
        order = np.argsort(np.concatenate([places, hard]), kind="stable")
        cost = np.concatenate([cost, np.full(len(hard), HARD_CUT, np.int64)])[order]
        places = np.concatenate([places, hard])[order]
    return places, cost


def best_cuts(places: Sequence[int], cost: Sequence[int], window: int) -> list[int]:
    """Indexes of the cuts, first and last place included, of least padding plus cost of cuts; no window exceeds `window`.

    best[j] = cost[j] + window - places[j] + min(best[i] + places[i]) over the places i at most a window before j. The minimum
    of that sliding range stands at the head of a queue whose values rise.
    """
    n = len(places)
    value, back, queue, head = [0] * n, [0] * n, [0], 0
    value[0] = places[0]
    for j in range(1, n):
        at = places[j]
        while places[queue[head]] < at - window:
            head += 1
        i = queue[head]
        back[j] = i
        v = value[i] + window + cost[j]  # best[j] + places[j]
        value[j] = v
        while len(queue) > head and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
        if head > 4096:
            del queue[:head]
            head = 0
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


class _Packer:
    """Documents in, pieces out; holds at most a block of tokens."""

    def __init__(self, ends: np.ndarray, window: int, first: int):
        self.ends, self.window, self.sequence = ends, window, first
        self.parts: list[tuple] = []  # doc_id, ids before, ids, all ids of the document
        self.held = 0
        self.out: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.parts.append((doc_id, 0, ids, len(ids)))
        self.held += len(ids)
        if self.held >= BLOCK:
            self.pack(last=False)

    def pack(self, last: bool) -> None:
        if not self.parts:
            return
        lengths = [len(p[2]) for p in self.parts]
        ids = np.concatenate([p[2] for p in self.parts])
        places, cost = cut_points(lengths, np.flatnonzero(self.ends[ids]) + 1, self.window)
        chosen = [int(places[i]) for i in best_cuts(places.tolist(), cost.tolist(), self.window)]
        part, used = 0, 0  # where the next window begins: ids of the part that are packed
        for begin, end in zip(chosen, chosen[1:] if last else chosen[1:-1], strict=False):
            offset = 0
            while offset < end - begin:
                doc_id, before, own, total = self.parts[part]
                take = min(len(own) - used, end - begin - offset)
                piece = own[used : used + take]
                self.out.append((doc_id, before + used, take, zlib.crc32(piece.tobytes()), total, self.sequence, offset, piece))
                offset += take
                used += take
                if used == len(own):
                    part, used = part + 1, 0
            self.sequence += 1
        self.parts = self.parts[part:]
        if used:
            doc_id, before, own, total = self.parts[0]
            self.parts[0] = (doc_id, before + used, own[used:].copy(), total)
        self.held = sum(len(p[2]) for p in self.parts)


def packed(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """Pieces of the documents (doc_id, text) in windows of at most `window` tokens, one row per piece.

    doc_id, start (ids of its document before it), length, ids_crc32 (of its ids as little-endian 32-bit integers), doc_tokens
    (with the end id), sequence_id, offset (its place in the window), and ids if asked for. A document's ids are followed by
    id 1; a null or empty text has that id alone. Windows are cut at ends of documents, ends of sentences, or, within
    sentences of more than a quarter of a window, every 64 tokens; the cuts of least padding plus cutting costs are taken. Rows
    that repeat a doc_id are documents of their own. Of other columns nothing is read. An empty table gives no rows.

    Documents keep the order of the input and each input partition is packed by itself, so nothing is shuffled and a lost
    task is repeated alone; the price is one window per partition that may be short. A window's id is its partition's
    number and its place there. A task holds half a million tokens, or one document where that has more.
    """
    path = tokenizer or default_tokenizer()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encoder(path), np.array([END_ID], "<u4").tobytes()
        packer = _Packer(sentence_ends(path), window, TaskContext.get().partitionId() << 40)
        for batch in small_batches(batches):
            texts = batch.column(1)
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                ids = encode(texts[i].as_py() or "") + last
                packer.add(doc_id, np.frombuffer(ids, "<u4"))
                if len(packer.out) >= 4096:
                    yield _batch(packer, with_ids)
        packer.pack(last=True)
        yield _batch(packer, with_ids)

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(pack, schema + ", ids array<int>" * with_ids)


def _batch(packer: _Packer, with_ids: bool) -> pa.RecordBatch:
    rows, packer.out = packer.out, []
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(7)]
    if with_ids:
        names.append("ids")
        columns.append(pa.array([r[7].astype(np.int32) for r in rows], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(columns, names=names)
