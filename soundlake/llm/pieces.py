"""SentencePiece encoding and decoding as relational operations on a lattice of substrings."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from soundlake.operators.lineage import cut, release

SPACE = "▁"
#: Rank of nothing: later than every merge.
NEVER = 1 << 30
#: Different words that one task handles: a word's lattice is some ten times its size.
WORDS_PER_TASK = 20_000
#: The commonest words, of so many characters at most, are known to every task with their ids; the others are folded where they stand.
COMMON, COMMON_LENGTH = 1 << 19, 64
#: Words are counted in runs of so many different ones; fewer places in a run are not worth a row.
RUN, LEAST = 1 << 17, 4


def merge_tree(text: str, rank: dict[str, int]):
    """How neighbouring pieces of ``text`` merge, best rank first, leftmost among equals: what is left, as nested (piece, left part, right part)."""
    parts = [(c, None, None) for c in text]
    while len(parts) > 1:
        best = min(((rank[a[0] + b[0]], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a[0] + b[0] in rank), default=None)
        if best is None:
            break
        i = best[1]
        parts[i : i + 2] = [(parts[i][0] + parts[i + 1][0], parts[i], parts[i + 1])]
    return parts


def piece_table(model_path: str) -> tuple[list[tuple], int]:
    """(rows of piece, id, rank, size, right, left for the pieces that merging can give, id of the piece for byte 0).

    ``right`` holds the endings of ``n`` characters that stand as pieces of their own while the piece is built, from rank ``born`` until rank ``gone``; ``left`` the same for its
    beginnings. The model fixes the size of the table.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
    rank = {sp.id_to_piece(i): order[sp.get_score(i)] for i in plain}
    if any(SPACE in p.lstrip(SPACE) for p in rank):
        raise ValueError("pieces reach across word ends; texts cannot be cut there")
    rows = []
    for i in plain:
        piece = sp.id_to_piece(i)
        tree = merge_tree(piece, rank)
        if len(tree) > 1:
            continue  # no order of merges ends there
        sides = []
        for side in (2, 1):
            spine, node, gone = [], tree[0], NEVER
            while node is not None:
                born = rank[node[0]] if len(node[0]) > 1 else -1
                spine.append((len(node[0]), born, gone))
                node, gone = node[side], born
            sides.append(spine)
        rows.append((piece, i, rank[piece] if len(piece) > 1 else NEVER, len(piece), *sides))
    zero = next((i for i in range(sp.get_piece_size()) if sp.is_byte(i)), -1)
    return rows, zero


def mixed(pieces: Iterable[str]) -> bool:
    """Whether a letter and another character, marks at the front aside, stand next to each other in a piece."""
    return any(a.isalpha() != b.isalpha() for p in pieces for a, b in pairwise(p.lstrip(SPACE)))


def units(text: Column, split: bool = False) -> Column:
    """The text with its spaces marked, cut before each run of marks, with ``split`` also where letters and other characters meet, which holds for pieces that are not ``mixed``.

    Nothing merges across these cuts. Empty and null texts have none.
    """
    marked = F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE)))
    kinds = [r"\p{L}", rf"[^\p{{L}}{SPACE}]"] if split else [f"[^{SPACE}]"]
    found = F.regexp_extract_all(marked, F.lit("|".join([*(f"{SPACE}*{k}+" for k in kinds), f"{SPACE}+"])), F.lit(0))
    return F.when(F.length(text) > 0, found).otherwise(F.array().cast("array<string>"))


def lattice(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """The rows of ``words`` with edges: all pieces in each unit, as (stop, start, id), by stop and start.

    Substrings of up to ``longest`` characters are exploded and joined to the piece table, whose size the model bounds. A character that is no piece becomes an edge
    without an id. The edges stay in the partition of their unit.
    """
    keep = words.columns
    spans = words.select(*keep, F.explode(F.sequence(F.lit(1), F.char_length("unit"))).alias("first"))
    ends = F.sequence(F.lit(1), F.least(F.lit(longest), F.char_length("unit") - F.col("first") + 1))
    spans = spans.select(*keep, "first", F.explode(ends).alias("size"))
    spans = spans.withColumn("sub", F.expr("substring(unit, first, size)"))
    hit = spans.join(F.broadcast(pieces), F.col("sub") == F.col("piece"), "left").where("id is not null or size = 1")
    edge = F.struct((F.col("first") + F.col("size") - 1).alias("stop"), (F.col("first") - 1).alias("start"), F.coalesce("id", F.lit(-1)).alias("id"))
    return hit.groupBy(*keep).agg(F.sort_array(F.collect_list(edge)).alias("edges"))


class Joints:
    """Whether two neighbouring pieces may stay apart, by their ids.

    They may not if a merge across the joint would have come before both were complete: if its rank comes while its two parts stand by themselves, on the spines of
    the pieces. That depends on the two pieces alone, so an answer is kept, up to ``KEPT`` of them, by both ids in one number. A character that is no piece (-1)
    merges with nothing. The spines lie one after the other in an array: as tuples they would be most of what a worker holds of the model.
    """

    KEPT = 1 << 18

    def __init__(self, table: list[tuple]):
        self.pieces, self.rank = {r[1]: r[0] for r in table}, {r[0]: r[2] for r in table}
        places = np.zeros(max(self.pieces, default=-1) + 2, np.int64)
        spines = {r[1]: (r[4], r[5]) for r in table}
        self.spines = []
        for side in (0, 1):
            for i, both in spines.items():
                places[i + 1] = len(both[side])
            flat = [step for i in sorted(spines) for step in spines[i][side]]
            self.spines.append((np.cumsum(places), np.array(flat, np.int32).reshape(-1, 3)))
        self.seen: dict[int, bool] = {}

    def free(self, a: int, b: int) -> bool:
        known = self.seen.get(a << 20 | b)
        return self.learn(a, b) if known is None else known

    def learn(self, a: int, b: int) -> bool:
        if len(self.seen) >= self.KEPT:
            self.seen.clear()
        known = self.seen[a << 20 | b] = a < 0 or b < 0 or not any(self._across(a, b))
        return known

    def _spine(self, side: int, i: int) -> list[list[int]]:
        places, flat = self.spines[side]
        return flat[places[i] : places[i + 1]].tolist()

    def _across(self, a: int, b: int) -> Iterator[bool]:
        left, right, begins = self.pieces[a], self.pieces[b], self._spine(1, b)
        for n, born, gone in self._spine(0, a):
            for m, since, until in begins:
                rank = self.rank.get(left[-n:] + right[:m])
                yield rank is not None and rank < gone and rank <= until and born <= until and since < gone


def best_path(length: int, edges: Iterable[tuple[int, int, int]], free: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    """(start, id) of the best path's edges through a unit, from its edges (stop, start, id) in order.

    Viterbi over the stops: the state of a stop is the last edge of the best path to it, and a step costs one at a joint that is not ``free``. The merging of a text is
    the one path without such a joint, so a stop keeps the first edge that arrives at no cost.
    """
    best: list[tuple[int, int] | None] = [None] * (length + 1)
    for stop, start, i in edges:
        if best[stop] is None and (start == 0 or free(best[start][1], i)):
            best[stop] = (start, i)
    path, at = [], length
    while at:
        path.append(best[at])
        at = path[-1][0]
    return path[::-1]


def folded(edges: DataFrame, table: list[tuple], zero: int) -> DataFrame:
    """unit, n, ids: the best path through each unit's lattice. A character that is no piece has the ids of its UTF-8 bytes."""
    held = edges.sparkSession.sparkContext.broadcast(Joints(table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free = held.value.free
        for batch in (part for b in batches for part in sliced(b, b.column(2).value_lengths())):
            units, lists = batch.column(0), batch.column(2)
            flat, ends = lists.flatten(), np.cumsum(lists.value_lengths().to_numpy()).tolist()
            steps = list(zip(*[flat.field(c).to_numpy().tolist() for c in range(3)], strict=True))
            out, at = [], 0
            for unit, end in zip(units.to_pylist(), ends, strict=True):
                path = best_path(len(unit), steps[at:end], free)
                out.append([x for start, i in path for x in ([i] if i >= 0 else [zero + b for b in unit[start].encode()])])
                at = end
            yield pa.record_batch([units, batch.column(1), pa.array(out, pa.list_(pa.int32()))], names=["unit", "n", "ids"])

    return edges.select("unit", "n", "edges").mapInArrow(run, "unit string, n long, ids array<int>")


#: Values of lists, or bytes of texts, that a task handles at once, if one row does not hold more.
TOGETHER, BYTES = 1 << 18, 1 << 18


def sliced(batch: pa.RecordBatch, sizes: pa.Array, most: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose ``sizes`` come to about ``most``."""
    run = np.cumsum(sizes.fill_null(0).to_numpy().astype(np.int64)) // most
    starts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in pairwise(starts):
        if b > a:
            yield batch.slice(a, b - a)


@cache
def kinds() -> np.ndarray:
    """Of each code point: 0 for the mark, 1 for a letter, 2 for the others."""
    kind = np.fromiter((2 - chr(i).isalpha() for i in range(0x110000)), np.uint8, 0x110000)
    kind[ord(SPACE)] = 0
    return kind


def code_points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)


def units_of(texts: pa.Array, split: bool) -> tuple[pa.Array, np.ndarray]:
    """What :func:`units` gives for all of the texts, one after the other, and the number of them up to each text's end."""
    marked = pc.replace_substring(texts.fill_null(""), " ", SPACE)
    marked = pc.if_else(pc.equal(pc.binary_length(marked), 0), "", pc.binary_join_element_wise(SPACE, marked, ""))
    raw, borders = marked.cast(pa.binary()), np.append(0, np.cumsum(pc.binary_length(marked).to_numpy().astype(np.int64)))
    data = b"".join(raw.to_pylist())
    code = code_points(data)
    kind, first = kinds()[code], np.ones(len(code), bool)
    first[1:] = (kind[1:] != kind[:-1]) & ((kind[1:] == 0) | ((kind[:-1] != 0) & split))
    begin = np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), dtype=np.int64)
    begin = np.append(0, begin)  # of each character, in bytes
    first[np.searchsorted(begin, borders[:-1][np.diff(borders) > 0])] = True
    cuts = np.append(begin[:-1][first], len(data))
    found = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data))
    return found, np.searchsorted(cuts[:-1], borders[1:])


def strings(found: pa.Array) -> list[str]:
    """The array's values, by way of NumPy, which is several times faster than one by one."""
    return found.to_numpy(zero_copy_only=False).tolist()


def counted(texts: DataFrame, split: bool) -> DataFrame:
    """unit, n: how often the units stand in the texts, the only column. Those that are long, or rare in all runs of a task, may be missing or counted short."""

    def rows(seen: Counter) -> pa.RecordBatch:
        often = [(w, n) for w, n in seen.items() if n >= LEAST]
        return pa.record_batch([pa.array([w for w, _ in often], pa.string()), pa.array([n for _, n in often], pa.int64())], names=["unit", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in (part for b in batches for part in sliced(b, pc.binary_length(b.column(0)), BYTES)):
            found = units_of(batch.column(0), split)[0].value_counts()
            found = found.filter(pc.less_equal(pc.utf8_length(found.field("values")), COMMON_LENGTH))
            for unit, n in zip(strings(found.field("values")), found.field("counts").to_numpy().tolist(), strict=True):
                seen[unit] += n
            if len(seen) >= RUN:
                yield rows(seen)
                seen.clear()
        yield rows(seen)

    return texts.mapInArrow(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


class Lattices:
    """The lattices of many units at once: each place descends the tree of the pieces' beginnings, all places in step, so the work is that of the edges found."""

    def __init__(self, table: list[tuple]):
        node, ids = {"": 0}, [-1]
        for piece, i, *_ in table:
            for n in range(1, len(piece) + 1):
                if piece[:n] not in node:
                    node[piece[:n]] = len(ids)
                    ids.append(-1)
            ids[node[piece]] = i
        down = sorted((node[p[:-1]] << 21 | ord(p[-1]), i) for p, i in node.items() if p)
        self.keys, self.nodes = (np.array(x, np.int64) for x in zip(*down, strict=True))
        self.ids = np.array(ids, np.int64)

    def edges(self, code: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """stop, start, id of all pieces in the units, by stop and start, as places in ``code``, which holds their characters, up to ``ends``; a character that is no piece has -1."""
        place, state, size, found = np.arange(len(code)), np.zeros(len(code), np.int64), 0, []
        end = np.repeat(ends, np.diff(ends, prepend=0))
        while len(place):
            key = state << 21 | code[place + size]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[at] == key
            size += 1
            state = np.where(there, self.nodes[at], 0)
            piece = (self.ids[state] >= 0) | (size == 1)
            found.append((place[piece] + size, place[piece], self.ids[state[piece]]))
            on = there & (place + size < end[place])
            place, state = place[on], state[on]
        stop, start, i = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(stop * (size + 1) - (stop - start), kind="stable")  # an earlier start is a longer piece
        return stop[order], start[order], i[order]


def folded_here(words: list[str], lattices: Lattices, joints: Joints, zero: int) -> pa.Array:
    """The ids of each word: :func:`best_path` through the lattices of all words, laid end to end."""
    code = code_points("".join(words).encode())
    ends = np.cumsum([len(w) for w in words])
    edges = lattices.edges(code, ends)
    begins = np.zeros(len(code) + 1, bool)
    begins[np.append(0, ends)] = True
    seen = joints.seen
    first, own, before = begins.tolist(), [None] * (len(code) + 1), [0] * (len(code) + 1)
    for a in range(0, len(edges[0]), TOGETHER):
        for stop, start, i in zip(*[e[a : a + TOGETHER].tolist() for e in edges], strict=True):
            if own[stop] is None:
                known = first[start] or seen.get(own[start] << 20 | i)
                if known or (known is None and joints.learn(own[start], i)):
                    own[stop], before[stop] = i, start
    back, at, on = np.array(before), ends, np.zeros(len(code) + 1, bool)
    while len(at):
        on[at] = True
        at = back[at]
        at = at[~begins[at]]
    stops = np.flatnonzero(on)
    ids = np.array([own[s] for s in stops.tolist()], np.int64)
    lost = np.flatnonzero(ids < 0)
    size = np.ones(len(ids), np.int64)
    if len(lost):
        raw = [[zero + b for b in chr(c).encode()] for c in code[stops[lost] - 1].tolist()]
        size[lost] = [len(r) for r in raw]
        ids = np.repeat(ids, size)
        ids[ids < 0] = [x for r in raw for x in r]
    borders = np.append(0, np.cumsum(size))[np.append(0, np.searchsorted(stops, ends, "right"))]
    return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(ids.astype(np.int32)))


def looked_up(docs: DataFrame, text: int, common: pa.Table, table: list[tuple], zero: int, split: bool) -> DataFrame:
    """``docs`` with the ids of the column numbered ``text``: units that are not ``common`` get their lattice and path in the task."""
    words, ids = (common[c].combine_chunks() for c in ("unit", "ids"))
    held = docs.sparkSession.sparkContext.broadcast((words, ids.cast(pa.list_(pa.int32())), Lattices(table), Joints(table)))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ids, lattices, joints = held.value
        place = {w: i for i, w in enumerate(strings(words))}
        for batch in (part for b in batches for part in sliced(b, pc.binary_length(b.column(text)), BYTES)):
            flat, ends = units_of(batch.column(text), split)
            coded = flat.dictionary_encode()
            different = strings(coded.dictionary)
            at = np.array([place.get(w, -1) for w in different], np.int64)
            rare = np.flatnonzero(at < 0)
            paths = ids.take(pa.array(np.maximum(at, 0))) if len(rare) < len(at) else None
            if len(rare):
                own = folded_here([different[i] for i in rare.tolist()], lattices, joints, zero)
                where = np.arange(len(at))
                where[rare] = np.arange(len(rare)) + (len(at) if paths else 0)
                paths = pa.concat_arrays([paths, own] if paths else [own]).take(pa.array(where))
            if paths is None:
                paths = pa.array([], pa.list_(pa.int32()))
            placed = paths.take(coded.indices)
            borders = np.append(0, np.cumsum(placed.value_lengths().to_numpy()))[np.append(0, ends)]
            yield pa.record_batch([*batch.columns, pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), placed.flatten())], names=[*names, "ids"])

    return docs.mapInArrow(run, docs.select(*names).schema.add("ids", ArrayType(IntegerType())))


def encode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ids (array of int): the pieces that merging gives, as the model's own encoder does; columns named ids are replaced.

    Words are cut out and counted, the ``COMMON`` commonest get their lattice and best path once for all, and the paths return to the places of the words within the
    texts' own tasks, where words that are not common get their lattice and path too: neither texts nor rare words are stored or moved. Null and empty texts have no ids;
    texts of any length and words of any length are encoded whole; repeated rows are encoded alike; an empty table stays empty; other columns stay. ``docs`` is read
    twice: cut it first where its lineage is long, or where it may give other rows the next time.
    """
    spark = docs.sparkSession
    table, zero = piece_table(model_path)
    pieces, longest = spark.createDataFrame([r[:2] for r in table], "piece string, id int"), max(r[3] for r in table)
    split = not mixed(r[0] for r in table)
    keep = [c for c in docs.columns if c.lower() != "ids"]
    names = [f"_{i}" for i in range(len(keep))]
    rows, text = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)]), keep.index(text_col)
    words = cut(counted(rows.select(names[text]), split).orderBy(F.desc("n"), "unit").limit(COMMON), "words")
    dealt = words.repartition(max(1, -(-words.count() // WORDS_PER_TASK)), "unit")
    common = folded(lattice(dealt, pieces, longest), table, zero).select("unit", "ids").toArrow()
    release(words)
    found = looked_up(rows, text, common, table, zero, split)
    return found.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "ids")


def decode(coded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``coded`` with decoded (string): pieces are looked up by id, put together as bytes, marks become spaces and the first one falls away.

    Null ids and no ids give an empty text, ids that are no piece or byte are left out. Other columns stay; a column named decoded is replaced.
    """
    table, zero = piece_table(model_path)
    spell = dict([(r[1], r[0].encode()) for r in table] + ([(zero + b, bytes([b])) for b in range(256)] if zero >= 0 else []))
    held = coded.sparkSession.sparkContext.broadcast(pa.array([spell.get(i, b"") for i in range(max(spell) + 2)], pa.binary()))  # as large as the model
    keep = [c for c in coded.columns if c.lower() != "decoded"]
    names = [f"_{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell = held.value
        for batch in (part for b in batches for part in sliced(b, b.column(len(names)).value_lengths())):
            lists = batch.column(len(names))
            at = lists.flatten().fill_null(-1).to_numpy()
            rows = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy()))
            raw = spell.take(pa.array(np.where((at >= 0) & (at < len(spell)), at, len(spell) - 1)))
            ends = np.append(0, np.cumsum(pc.binary_length(raw).to_numpy())).astype(np.int32)[rows]
            text = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends.tobytes()), raw.buffers()[2] or pa.py_buffer(b"")])
            yield pa.record_batch([*batch.columns[: len(names)], text], names=[*names, "_raw"])

    rows = coded.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col(ids_col).cast("array<int>").alias("_ids"))
    found = rows.mapInArrow(run, rows.select(*names).schema.add("_raw", "binary"))
    text = F.replace(F.decode("_raw", "UTF-8"), F.lit(SPACE), F.lit(" "))
    return found.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], F.regexp_replace(text, "^ ", "").alias("decoded"))
