"""Personal data: fixed patterns as seeds, then contextual patterns learned from them by bootstrapping."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundlake.llm.words import chain, parts, text_bytes, word_hashes
from soundlake.operators.lineage import cut, release

KINDS = ("email", "ip", "card", "phone")
#: A context can become a pattern once it precedes this many different accepted identifiers (seeds or new ones) of one kind.
SUPPORT = 3
#: Share of a context's occurrences that must be (believed) entities; belief that a new identifier needs.
RELIABLE, ACCEPT = 0.5, 0.8
#: Longest new identifier, in code points.
LONGEST = 64

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MARK = re.compile(r"[0-9@]")
_SPACE = frozenset(" \t\n\v\f\r")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def _luhn(digits: str) -> bool:
    back = [int(c) for c in reversed(digits)]
    return (sum(back[::2]) + sum(_DOUBLED[d] for d in back[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, found from each @ so that long words without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start, in code points; end exclusive.

    An ip match starts at the start of its digit run: if no match starts there, none starts inside the run. Possessive repeats give what
    the plain ones give, since what follows a run is never in it; so long runs of digits are read once.
    """
    found = [(0, a, b) for a, b in _emails(text)]
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return found


def unmarked(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Words with a digit or @, of 5 to ``LONGEST`` code points without outer punctuation, that touch no span."""
    taken = sorted((a, b) for _, a, b in spans)
    starts = [a for a, _ in taken]
    m = _MARK.search(text)
    while m:
        a, b = m.start(), m.end()
        while a > 0 and text[a - 1] not in _SPACE and m.start() - a <= LONGEST:
            a -= 1
        while b < len(text) and text[b] not in _SPACE and b - m.end() <= LONGEST:
            b += 1
        resume = b
        while a < b and text[a] in "\"'([{<,;:":
            a += 1
        while b > a and text[b - 1] in "\"')]}>,;:.!?":
            b -= 1
        near = bisect.bisect_left(starts, b)
        reach = max((y for _, y in taken[max(0, near - 8) : near]), default=0)
        if 5 <= b - a <= LONGEST and reach <= a:
            yield a, b
        m = _MARK.search(text, max(resume, m.end()))


def looks_like(kind: int, word: str) -> bool:
    """Whether a word could be an identifier of the kind at all."""
    digits = sum("0" <= c <= "9" for c in word)
    if kind == 0:
        return "@" in word or any(c.isalpha() for c in word)
    return digits >= (4, 12, 7)[kind - 1] and not any(c.isalpha() for c in word)


class Contexts:
    """Hashes of the one and two words before a place in each text of a batch."""

    def __init__(self, texts: pa.Array):
        data, bounds = text_bytes(texts)
        self.bounds = bounds
        self.hashes, self.starts, self.ends, self.first = word_hashes(data, bounds)
        two = chain(self.hashes, 2)
        self.two = np.concatenate([np.zeros(min(1, len(self.hashes)), np.uint64), two])

    def before(self, row: int, byte: int) -> tuple[int | None, int | None]:
        """(one word, two words) that end before ``byte`` of text ``row``; as signed 64-bit numbers."""
        k = int(np.searchsorted(self.ends, self.bounds[row] + byte, "right")) - 1
        one = k >= self.first[row]
        both = k - 1 >= self.first[row]
        return (int(self.hashes[k].view(np.int64)) if one else None, int(self.two[k].view(np.int64)) if both else None)


def _value(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def instances(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Pattern-instance graph of the texts: base spans and unmarked words with the contexts before them.

    Columns: kind (0-3; null where unmarked), like (bits of the kinds it could be), value (hash), one, two (contexts).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, 0):
            contexts, rows = Contexts(part.column(0)), []
            for i, text in enumerate(part.column(0).to_pylist()):
                if not text:
                    continue
                plain = text.isascii()
                spans = base_spans(text)
                found = [(k, a, b) for k, a, b in spans] + [(None, a, b) for a, b in unmarked(text, spans)]
                for kind, a, b in found:
                    word = text[a:b]
                    like = 1 << kind if kind is not None else sum(looks_like(k, word) << k for k in range(4))
                    if like:
                        rows.append((kind, like, _value(word), *contexts.before(i, a if plain else len(text[:a].encode("utf-8", "surrogatepass")))))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), *[pa.int64()] * 3), strict=True)], names=["kind", "like", "value", "one", "two"])

    return docs.select(text_col).mapInArrow(run, "kind int, like int, value long, one long, two long")


def _slots(hashes: DataFrame, column: str) -> np.ndarray:
    """Which of the 2^22 values of their low bits the hashes have: a filter of fixed size that loses none of them."""
    seen = np.zeros(1 << 22, bool)
    seen[hashes.select(F.col(column).bitwiseAND(len(seen) - 1).cast("int").alias("slot")).distinct().toArrow()["slot"].to_numpy()] = True
    return seen


def occurrences(docs: DataFrame, patterns: DataFrame, text_col: str = "text") -> DataFrame:
    """How often each of the contexts ``patterns(pattern long)``, which do not repeat, occurs before anything, over all texts: pattern, total.

    Contexts in a slot of some pattern are counted over the texts of a task (a million different ones at a time), added up, and joined to the patterns.
    """
    packed = np.packbits(_slots(patterns, "pattern"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, pattern, total = np.unpackbits(packed).view(bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in parts(batches, 0):
            c = Contexts(part.column(0))
            pair = np.ones(len(c.two), bool)
            pair[c.first[:-1][c.first[:-1] < len(pair)]] = False
            h = np.concatenate([c.hashes, c.two[pair]]).view(np.int64)
            h = h[seen[h & (len(seen) - 1)]]
            pattern, place = np.unique(np.concatenate([pattern, h]), return_inverse=True)
            total = np.bincount(place, np.concatenate([total, np.ones(len(h), np.int64)]), len(pattern)).astype(np.int64)
            if len(pattern) > 1 << 20:
                yield pa.record_batch([pa.array(pattern), pa.array(total)], names=["pattern", "total"])
                pattern, total = pattern[:0], total[:0]
        yield pa.record_batch([pa.array(pattern), pa.array(total)], names=["pattern", "total"])

    found = docs.select(text_col).mapInArrow(run, "pattern long, total long")
    return found.groupBy("pattern").agg(F.sum("total").alias("total")).join(patterns, "pattern", "left_semi")


def bootstrap(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(reliable contexts: pattern, kind, r; new identifiers: kind, value). Everything stays in Spark.

    Nodes of the graph are contexts and identifiers (kind, value), wherever these stand; edges count how often one precedes the other. Base spans are the seeds. Each round
    a new identifier's belief is 1 - product(1 - reliability) over its reliable contexts, and a context's reliability is the sum of its instances' beliefs
    over all its occurrences, whatever follows there. A context is reliable from ``RELIABLE`` on, if it precedes ``SUPPORT`` different identifiers that are seeds or believed to
    ``ACCEPT``; others count as nothing, so words after ordinary phrases stay untouched. Beliefs only grow, and rounds go on until nothing changes
    by more than a millionth. Contexts that cannot become reliable, whatever is believed, leave the graph first.
    """
    spark = docs.sparkSession
    found = cut(instances(docs, text_col), "instances")
    ends = found.select("value", F.col("kind").isNotNull().alias("seed"), F.expr("filter(sequence(0, 3), k -> shiftright(like, k) & 1 = 1)").alias("kinds"), F.explode(F.array_compact(F.array("one", "two"))).alias("pattern"))
    ends = ends.select("pattern", F.explode("kinds").alias("kind"), "value", "seed")
    links = cut(ends.groupBy("pattern", "kind", "value").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed")), "links")
    candidates = links.groupBy("pattern", "kind").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("values"))
    candidates = cut(candidates.where(F.col("values") >= SUPPORT), "candidates")
    totals = occurrences(docs, cut(candidates.select("pattern").distinct(), "patterns"), text_col)
    live = candidates.join(totals, "pattern").where(F.col("all") >= RELIABLE * F.col("total"))
    edges = cut(links.join(cut(live.select("pattern", "kind", "total"), "live"), ["pattern", "kind"]), "edges")
    known, new = (spark.createDataFrame([], t) for t in ("pattern long, kind int, r double", "kind int, value long"))
    if edges.where("seed").isEmpty():
        return known, new
    while True:
        belief = edges.where("not seed").join(known, ["pattern", "kind"]).groupBy("kind", "value").agg((1 - F.product(1 - F.col("r"))).alias("belief"))
        belief = cut(belief, "belief")
        held = edges.join(belief, ["kind", "value"], "left").withColumn("b", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("belief", F.lit(0.0))))
        rated = held.groupBy("pattern", "kind").agg((F.sum(F.col("n") * F.col("b")) / F.max("total")).alias("r"), F.count_if(F.col("b") >= ACCEPT).alias("values"))
        rated = rated.where((F.col("r") >= RELIABLE) & (F.col("values") >= SUPPORT))
        rated = cut(rated.select("pattern", "kind", F.least("r", F.lit(0.999)).alias("r")), "known")
        moved = rated.join(known.withColumnRenamed("r", "old"), ["pattern", "kind"], "left").where("old is null or r - old > 1e-6")
        if moved.isEmpty():
            return known, cut(belief.where(F.col("belief") >= ACCEPT).select("kind", "value"), "new")
        release(belief)
        known = rated


def learn(docs: DataFrame, text_col: str = "text") -> dict[int, dict[int, float]]:
    """The reliable contexts of :func:`bootstrap` on the driver: pattern -> kind -> reliability."""
    known: dict[int, dict[int, float]] = {}
    for row in bootstrap(docs, text_col)[0].collect():
        known.setdefault(row.pattern, {})[row.kind] = row.r
    return known


def places(docs: DataFrame, new: DataFrame, text_col: str = "text") -> DataFrame:
    """Where the identifiers ``new(kind, value)`` stand, whatever is before them: key (digest of the text), more (array of kind, start, end). One row per different text."""
    packed = np.packbits(_slots(new, "value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.unpackbits(packed).view(bool)
        for part in parts(batches, 1):
            rows = []
            for key, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                for a, b in unmarked(text or "", base_spans(text or "")):
                    value = _value(text[a:b])
                    if seen[value & (len(seen) - 1)]:
                        rows += [(key, k, a, b, value) for k in range(4) if looks_like(k, text[a:b])]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), *[pa.int64()] * 3), strict=True)], names=["key", "kind", "start", "end", "value"])

    found = docs.select(F.sha2(text_col, 256).alias("key"), text_col).mapInArrow(run, "key string, kind int, start long, end long, value long")
    found = found.join(new, ["kind", "value"]).select("key", "kind", "start", "end").distinct()
    return found.groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))


def marked(docs: DataFrame, patterns: dict[int, dict[int, float]], text_col: str = "text", more: DataFrame | None = None) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone (base spans), base (their string), spans (array of kind, start, end) and redacted (text).

    ``redacted`` has each merged stretch of spans replaced by the kind of its first span in brackets; it is null where the text is.
    Beside base spans, words that ``patterns`` make believed by what stands before them are marked, and the spans ``more`` (of :func:`places`) of each text.
    Added columns replace columns of the same name.
    """
    names = ["n_email", "n_ip", "n_card", "n_phone", "base", "spans", "redacted"]
    keep = [f.name for f in docs.schema if f.name.lower() not in names]
    at = keep.index(text_col)
    wider = more is not None
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, at):
            texts = part.column(at).to_pylist()
            contexts = Contexts(part.column(at)) if patterns else None
            extra = part.column(len(keep)).to_pylist() if wider else [None] * len(texts)
            counts, base, spans, redacted = [], [], [], []
            for i, raw in enumerate(texts):
                text = raw or ""
                found = base_spans(text)
                counts.append([sum(s[0] == k for s in found) for k in range(4)])
                base.append(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in found))
                if patterns:
                    plain = text.isascii()
                    for a, b in unmarked(text, found):
                        known = [patterns[c] for c in contexts.before(i, a if plain else len(text[:a].encode("utf-8", "surrogatepass"))) if c in patterns]
                        word = text[a:b]
                        for k in range(4):
                            doubt = 1.0
                            for p in known:
                                doubt *= 1 - p.get(k, 0.0)
                            if 1 - doubt >= ACCEPT and looks_like(k, word):
                                found = [*found, (k, a, b)]
                found = sorted(found + [s for e in extra[i] or [] if (s := (e["kind"], e["start"], e["end"])) not in found])
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                redacted.append(None if raw is None else _redact(text, found))
            cols = [pa.array([c[k] for c in counts], pa.int64()) for k in range(4)]
            cols += [pa.array(base, pa.string()), pa.array(spans, span), pa.array(redacted, pa.string())]
            yield pa.record_batch([*part.columns[: len(keep)], *cols], names=[*keep, *names])

    kinds = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in keep)
    source = docs.select(*keep)
    if wider:
        key = "_" * (1 + max(map(len, keep)))  # no name of docs
        source = source.withColumn(key, F.sha2(text_col, 256)).join(more.select(F.col("key").alias(key), F.col("more").alias(key + "_")), key, "left").select(*keep, key + "_")
    return source.mapInArrow(
        run, kinds + ", n_email long, n_ip long, n_card long, n_phone long, base string, spans array<struct<kind:int,start:bigint,end:bigint>>, redacted string"
    )


def _redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def personal_data(docs: DataFrame) -> DataFrame:
    """:func:`marked` with the base spans and every place of the new identifiers that :func:`bootstrap` finds in the same documents.

    Null and empty texts have no spans; repeated rows are marked alike (and count as different occurrences); an empty table gives no rows; extra
    columns stay. Texts are read three times and not shuffled where nothing new is found; else they are read once more and joined to the spans by their digests.
    """
    new = bootstrap(docs)[1]
    return marked(docs, {}, more=None if new.isEmpty() else cut(places(docs, new), "places"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_chars`` counted anew where the column exists."""
    names = docs.columns
    slim = docs.toDF(*[f"c{i}" if c != "text" else c for i, c in enumerate(names)])
    done = personal_data(slim)
    back = {c: F.col(f"c{i}") for i, c in enumerate(names) if c != "text"} | {"text": F.col("redacted")}
    if "n_chars" in back:
        back["n_chars"] = F.when(F.col("redacted") == F.col("text"), back["n_chars"]).otherwise(F.char_length("redacted").cast(docs.schema["n_chars"].dataType))
    return done.select(*[back[c].alias(c) for c in names])
