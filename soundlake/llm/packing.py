"""Tokenise whole documents and pack them into sequences by bounded-space online best fit."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundlake.operators.lineage import cut

LENGTH = 4096
#: Bins that one task keeps open.
OPEN_BINS = 4096
#: Pieces that one task packs.
PIECES_PER_TASK = 131072
#: Words and parts of words a Python worker remembers, and the longest of them; only speed depends on these.
_KNOWN_WORDS, _KNOWN_PARTS, _LONGEST_KNOWN = 300_000, 600_000, 64
#: White space for Python's split, but not for the tokenizer.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_LOADED: dict[str, Encoder] = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, the others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class _Known(dict):
    """A cache that asks ``find`` for what it lacks and forgets all when it is full; long keys are not kept."""

    def __init__(self, find, most: int):
        super().__init__()
        self.find, self.most = find, most

    def __missing__(self, key: str) -> bytes:
        value = self.find(key)
        if len(key) <= _LONGEST_KNOWN:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Encoder:
    """texts -> ids of each text as little-endian uint32 bytes, without special tokens.

    For tokenizers that drop white space and never join characters across it: words are encoded one by one and remembered. Where the tokenizer is a byte-level one over
    lower-cased text, words of simple letters are cut by its own pattern and the parts go to its model directly. Everything else goes through the tokenizer whole: texts
    with special-token strings or odd separators, words with letters from U+0130 on, whose case and composition are not simple.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.words, self.parts = _Known(self._word, _KNOWN_WORDS), _Known(self._part, _KNOWN_PARTS)
        self.ids = [i.to_bytes(4, "little") for i in range(self.tok.get_vocab_size(True))]
        self.letters = _byte_letters()
        spec = json.loads(self.tok.to_str())
        norm = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        simple = norm == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in pre] == ["Split", "ByteLevel"]
        simple = simple and "Regex" in pre[0]["pattern"] and pre[0]["invert"] and not (pre[1]["use_regex"] or pre[1]["add_prefix_space"])
        self.cut = regex.compile(pre[0]["pattern"]["Regex"]).findall if simple else None

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _part(self, part: str) -> bytes:
        word = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
        return b"".join([self.ids[t.id] for t in self.tok.model.tokenize(word)])

    def _word(self, word: str) -> bytes:
        if self.cut is None or not word.isascii() and max(word) >= "\u0130":
            return self.whole([word])[0]
        found = self.cut(word.lower())
        return self.parts[found[0]] if len(found) == 1 else b"".join(map(self.parts.__getitem__, found))

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [self._text(t) for t in texts]

    def _text(self, text: str) -> bytes:
        if any(s in text for s in self.special) or any(s in text for s in _SEPARATORS):
            return self.whole([text])[0]
        return b"".join(map(self.words.__getitem__, text.split()))


def encoder(path: str) -> Encoder:
    """One per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as token pieces of at most ``length`` ids: doc_id, piece, start, length, ids_crc32, ids (bytes, little-endian uint32).

    Each document is its ids and then ``end_id``; a null text is empty. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                row, piece, start, n, crc, kept = [], [], [], [], [], []
                for i, ids in enumerate(encode([t or "" for t in part.column(1).to_pylist()])):
                    ids += end
                    for k, p in enumerate(range(0, len(ids), 4 * length)):
                        block = ids[p : p + 4 * length]
                        row.append(i), piece.append(k), start.append(p // 4), n.append(len(block) // 4), crc.append(zlib.crc32(block)), kept.append(block)
                yield pa.record_batch(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(kept, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary")


class OpenBins:
    """At most ``most`` open bins, in a bitset keyed by free space.

    ``put(n)`` gives (bin number, offset). The bin with the least room that still fits wins; where none fits, a new bin opens, and if that makes
    too many, the fullest open one closes first.
    """

    def __init__(self, length: int = LENGTH, most: int = OPEN_BINS):
        self.length, self.most, self.free, self.by_free, self.open, self.made = length, most, 0, {}, 0, 0

    def put(self, n: int) -> tuple[int, int]:
        fits = self.free >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            number = self._take(room)
        else:
            if self.open >= self.most and n < self.length:
                self._take((self.free & -self.free).bit_length() - 1)
            room, number = self.length, self.made
            self.made += 1
        if room > n:
            self.by_free.setdefault(room - n, []).append(number)
            self.free |= 1 << (room - n)
            self.open += 1
        return number, self.length - room

    def _take(self, room: int) -> int:
        bins = self.by_free[room]
        number = bins.pop()
        self.open -= 1
        if not bins:
            self.free &= ~(1 << room)
        return number


def pack(items: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, per_task: int = PIECES_PER_TASK) -> DataFrame:
    """``items`` (doc_id, piece, length, ...) with sequence_id and offset; the other columns stay.

    Pieces are dealt out by a hash into one task per ``per_task`` of them and packed in a fixed order, so a task that is run again gives the
    same sequences. Only small columns should be in ``items``: ids stay where they were written.
    """
    tasks = max(1, -(-items.count() // per_task))
    order = F.xxhash64("doc_id", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = OpenBins(length, open_bins), TaskContext.get().partitionId() << 32
        for batch in batches:
            put = [bins.put(n) for n in batch.column("length").to_pylist()]
            out = [*batch.columns, pa.array([first + b for b, _ in put], pa.int64()), pa.array([o for _, o in put], pa.int64())]
            yield pa.record_batch(out, names=[*batch.schema.names, "sequence_id", "offset"])

    dealt = items.repartition(tasks, F.col("doc_id"), F.col("piece")).sortWithinPartitions(order, "doc_id", "piece", "length", "ids_crc32")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return dealt.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """Place of every piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Nulls and empty texts give one piece of one id; longer documents than ``length`` are cut, the last piece may be short. Rows that repeat a
    document are packed as often as they occur. Rows without id are packed as well. Extra columns are not read; empty input gives no rows.
    """
    found = cut(pieces(docs, path, length).drop("ids"), "pieces")
    return pack(found, length)
