"""Language identification with bit-sliced Bloom filters over n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundlake.llm.words import lane, mix, parts, text_bytes

#: Bytes in an n-gram; slots of the filter; hash functions.
WIDTH, SLOTS, HASHES = 4, 1 << 19, 3
#: Documents of a language that are read to learn its n-grams, about; a deterministic sample where there are more.
FIT_DOCS = 5000
#: An n-gram belongs to a language if it makes up this share of its n-grams, and this share of what it makes up in the language that has it most.
LEAST_SHARE, RELATIVE_SHARE = 5e-6, 0.1
#: Bytes of text whose n-grams are held at once; the arrays below take many times that.
AT_ONCE = 1 << 18
#: Languages that fit into a mask.
MOST_LANGUAGES = 63

#: Letters stay (A-Z is lower-cased, bytes of other letters too); everything else is one kind of gap.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as uint64, text of each): windows of ``WIDTH`` bytes over the lower-cased text, those without a letter left out."""
    lower = pa.array([None if t is None else t.lower() for t in texts.to_pylist()], pa.large_string())
    data, bounds = text_bytes(lower)
    data = _FOLD[data]
    n = len(data) - 8
    if n < WIDTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = lane(data, np.arange(n - WIDTH + 1)) & np.uint64((1 << (8 * WIDTH)) - 1)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(value)]
    whole = np.arange(len(value)) + WIDTH <= bounds[1:][row]
    gap = np.uint64(int.from_bytes(b" " * WIDTH, "little"))
    use = whole & (value != gap)
    return value[use], row[use]


def slots(value: np.ndarray, count: int = SLOTS) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        return [(mix(value + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(count)).astype(np.int64) for k in range(HASHES)]


@dataclass
class Filters:
    """``masks[slot]`` has bit l set if some n-gram of language l hashes there; ``chance[l]`` is the rate of false positives of l."""

    languages: list[str]
    masks: np.ndarray
    chance: np.ndarray


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = FIT_DOCS, salt: Column | None = None) -> Filters:
    """Learn the filters from labelled documents: every row of ``docs`` with a language, or about ``per_language`` rows of each.

    Counts of n-grams are made in Spark. What comes to the driver is the filter itself, of fixed size. ``salt`` picks the sample only (a hash of the
    text where it is not given).
    """
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), (F.xxhash64(text_col) if salt is None else salt).alias("pick"))
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(sizes)
    if not languages:
        return Filters([], np.zeros(SLOTS, np.uint64), np.zeros(0))
    share = F.element_at(F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, per_language / sizes[k]))]), F.col("lang"))
    rows = rows.where(F.pmod("pick", F.lit(1 << 20)) < share * (1 << 20)).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, 1, AT_ONCE):
            value, row = grams(part.column(1))
            number = {k: i for i, k in enumerate(languages)}
            of = np.array([number[x] for x in part.column(0).to_pylist()], np.uint64)[row]
            both, n = np.unique(value | (of << np.uint64(32)), return_counts=True)
            yield pa.record_batch([pa.array((both >> np.uint64(32)).astype(np.int32)), pa.array((both & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)], names=["l", "gram", "n"])

    counts = rows.mapInArrow(count, "l int, gram long, n long").groupBy("l", "gram").agg(F.sum("n").alias("n"))
    totals = F.broadcast(counts.groupBy("l").agg(F.sum("n").alias("all")))  # one row per language
    rates = counts.join(totals, "l").select("gram", "l", (F.col("n") / F.col("all")).alias("rate")).where(F.col("rate") >= LEAST_SHARE)
    top = rates.groupBy("gram").agg(F.max("rate").alias("top"), F.collect_list(F.struct("l", "rate")).alias("of"))  # at most one per language
    bits = F.aggregate("of", F.lit(0).cast("long"), lambda a, x: F.when(x["rate"] >= RELATIVE_SHARE * F.col("top"), a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x["l"]))).otherwise(a))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = slots(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64))
            yield pa.record_batch([pa.array(np.concatenate(at)), pa.concat_arrays([batch.column(1)] * HASHES)], names=["slot", "mask"])

    placed = top.select("gram", bits.alias("mask")).mapInArrow(place, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask"))
    found = placed.toArrow()  # at most SLOTS rows
    masks = np.zeros(SLOTS, np.uint64)
    masks[found["slot"].to_numpy()] = found["mask"].to_numpy().astype(np.uint64)
    fill = np.array([np.count_nonzero(masks >> np.uint64(i) & np.uint64(1)) for i in range(len(languages))]) / SLOTS
    return Filters(languages, masks, fill**HASHES)


def identify(docs: DataFrame, filters: Filters, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score.

    Each n-gram's slots are ANDed, which gives the mask of all languages that have it. A language's score is its share of the text's n-grams,
    corrected for the false positives that its filter's fill lets expect; the best one wins, the first by name among equals. Texts that are
    null or without letters give 'und' and 0, texts too short for an n-gram the language of the padded text. Repeated rows are scored
    alike, empty tables stay empty, other columns stay; columns named lang_pred and score are replaced.
    """
    keep = [f.name for f in docs.schema if f.name.lower() not in ("lang_pred", "score")]
    at = keep.index(text_col)
    share = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.masks.astype("u1" if len(filters.languages) <= 8 else "u8"), filters.chance))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, masks, chance = share.value
        for part in parts(batches, at, AT_ONCE):
            texts = [t or "" for t in part.column(at).to_pylist()]
            lettered = np.array([any(map(str.isalpha, t)) for t in texts], bool)
            padded = pa.array([f" {t.strip()}  " if len(t) < WIDTH else t for t in texts], pa.large_string())
            value, row = grams(padded)
            mask = np.full(len(value), (1 << len(languages)) - 1, np.uint64).astype(masks.dtype)
            for s in slots(value):
                mask &= masks[s]
            n = np.bincount(row, minlength=len(texts))
            hits = np.stack([np.bincount(row[mask >> masks.dtype.type(k) & masks.dtype.type(1) == 1], minlength=len(texts)) for k in range(len(languages))], 1) if languages else np.zeros((len(texts), 1))
            free = chance if languages else np.zeros(1)
            score = np.clip((hits / np.maximum(n, 1)[:, None] - free) / (1 - np.minimum(free, 0.999)), 0, 1)
            best = score.argmax(1)
            known = lettered & bool(languages)
            names = [languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            top = np.where(known, score[np.arange(len(texts)), best], 0.0)
            yield pa.record_batch([*part.columns, pa.array(names, pa.string()), pa.array(top, pa.float64())], names=[*keep, "lang_pred", "score"])

    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in keep)
    return docs.select(*keep).mapInArrow(run, f"{kinds}, lang_pred string, score double")


#: The pipeline keeps documents of which the predicted language has at least this share of the n-grams. Short texts with a licence line or a key in them, and
#: texts in several languages, come down to 0.38; other scripts and noise stay near 0.
KEEP_SCORE = 0.25


def training(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: crc32 of the id as text is not 2 modulo 4. A null id is not learned from."""
    return docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)


def known_language(docs: DataFrame) -> DataFrame:
    """``docs`` without those in no learned language: no letters, or too few n-grams that the best language has. Columns stay."""
    names = docs.columns
    filters = fit(training(docs))
    slim = docs.toDF(*[f"c{i}" if c != "text" else c for i, c in enumerate(names)])
    kept = identify(slim, filters).where((F.col("lang_pred") != "und") & (F.col("score") >= KEEP_SCORE))
    return kept.select(*[F.col("text" if c == "text" else f"c{i}").alias(c) for i, c in enumerate(names)])
