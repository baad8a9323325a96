"""Documents packed into containers of a fixed capacity, related ones together: BM25 retrieval fills each seed's window.

Frequencies of terms are counted over all documents. Documents are dealt to shards of bounded size by their rarest terms
that others share, which weigh most in BM25, so that related ones meet. A shard builds an inverted index of its items; the
largest unused item seeds a container, and its unused neighbours by BM25 join in order of score as long as they fit. What
room is left then takes the largest unused items that fit. Only items over the capacity are divided.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import hot_join
from ..session import cut
from .tokens import DEFAULT_FILE, load

SCHEMA = "container_id long, position int, doc_id long, part_no int, n_parts int, from_token long, to_token long, n_tokens long"


class Index:
    """BM25 over items given as arrays of token ids.

    ``stats`` are the items' number, their mean size and each term's frequency where more than these items count.
    """

    def __init__(self, items: list[np.ndarray], k1: float = 1.2, b: float = 0.75, stats: tuple[int, float, np.ndarray] | None = None):
        n = len(items)
        sizes = np.array([len(x) for x in items], float)
        owner = np.repeat(np.arange(n), [len(x) for x in items])
        ids = np.concatenate(items) if n else np.zeros(0, int)
        pair, tf = np.unique(ids.astype(np.int64) * n + owner, return_counts=True) if n else (ids, ids)
        term, doc = pair // max(n, 1), pair % max(n, 1)
        self.terms, first, df = np.unique(term, return_index=True, return_counts=True)
        many, mean, among = stats or (n, sizes.mean() if n else 1, None)
        spread = df if among is None else among[self.terms]
        idf = np.log((many - spread + 0.5) / (spread + 0.5))
        norm = k1 * (1 - b + b * sizes / max(mean, 1)) if n else sizes
        self.first, self.doc = first, doc
        self.pair = np.repeat(np.arange(len(df)), df) * n + doc
        self.weight = np.repeat(idf, df) * tf * (k1 + 1) / (tf + norm[doc])
        self.n = n
        # the terms of each item that tell it from others; those in over half of the items weigh nothing
        keep = np.repeat(idf > 0, df)
        order = np.argsort(doc[keep], kind="stable")
        self.term_of = np.repeat(np.arange(len(df)), df)[keep][order]
        self.starts = np.searchsorted(doc[keep][order], np.arange(n + 1))

    def scores(self, seed: int, limit: int | None = None) -> np.ndarray:
        """The score for the seed's terms of every item, or of the first ``limit`` items."""
        limit = self.n if limit is None else limit
        terms = self.term_of[self.starts[seed] : self.starts[seed + 1]]
        if not len(terms):
            return np.zeros(limit)
        spans = list(zip(self.first[terms].tolist(), np.searchsorted(self.pair, terms * self.n + limit).tolist()))
        return np.bincount(np.concatenate([self.doc[a:b] for a, b in spans]), np.concatenate([self.weight[a:b] for a, b in spans]), limit)

    def keep(self, items: np.ndarray) -> None:
        """Leave out all items but those marked: they score 0 from now on, and the others as before."""
        kept = items[self.doc]
        self.first = np.concatenate([[0], np.cumsum(kept)])[self.first]
        self.doc, self.weight, self.pair = self.doc[kept], self.weight[kept], self.pair[kept]


def pack(sizes: list[int], tokens: list[np.ndarray], capacity: int, stats: tuple[int, float, np.ndarray] | None = None) -> list[list[int]]:
    """Containers as lists of items; every item once, none over ``capacity`` in sum. Ties go to the earlier item."""
    size = np.array(sizes, np.int64)
    # the index holds the items by size, so that those too large for the room cost nothing
    order = np.argsort(size, kind="stable")
    ordered, rank = size[order], np.argsort(order)
    index, indexed = Index([tokens[i] for i in order], stats=stats), len(sizes)
    unused = np.ones(len(sizes), bool)
    stock = sorted((s, -i) for i, s in enumerate(sizes))  # ascending; of equal sizes the earliest last
    out = []

    def take(i: int) -> None:
        unused[rank[i]] = False
        stock.pop(bisect.bisect_left(stock, (sizes[i], -i)))

    while stock:
        seed = -stock[-1][1]
        take(seed)
        own, room = [seed], capacity - sizes[seed]
        if stock and stock[0][0] <= room:
            if len(stock) < 0.85 * indexed:
                index.keep(unused)
                indexed = len(stock)
            limit = int(np.searchsorted(ordered, room, side="right"))
            score = index.scores(rank[seed], limit)
            near = np.flatnonzero((score > 0) & unused[:limit])
            near = near[np.lexsort((order[near], -score[near]))]
            fits = ordered[near]
            while len(near) and fits[k := int((fits <= room).argmax())] <= room:  # the next that fits
                i = int(order[near[k]])
                take(i)
                own.append(i)
                room -= sizes[i]
                near, fits = near[k + 1 :], fits[k + 1 :]
                if not stock or stock[0][0] > room:
                    break
        while (k := bisect.bisect_right(stock, (room, 1)) - 1) >= 0:
            i = -stock[k][1]
            take(i)
            own.append(i)
            room -= sizes[i]
        out.append(own)
    return out


def _parts(ids: np.ndarray, capacity: int) -> list[np.ndarray]:
    return [ids[k : k + capacity] for k in range(0, len(ids), capacity)]


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column's rows in one array, without copies, and where each row's begin."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data.view(kind), (bounds - bounds[0]) // np.dtype(kind).itemsize


def rarest(terms: np.ndarray, starts: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row's terms the two rarest that others have too, -1 where there is none; of equal ones the lower.

    Row ``i`` holds ``terms[starts[i] : starts[i + 1]]``, ascending.
    """
    never = np.iinfo(np.int64).max
    rows = len(starts) - 1
    owner = np.repeat(np.arange(rows), np.diff(starts))
    rare = among[terms].astype(np.int64)
    # frequency first, then the term: one number to take the least of
    rank = np.where(rare > 1, rare * len(among) + terms, never)
    out = []
    for _ in range(2):
        least = np.full(rows, never)
        np.minimum.at(least, owner, rank)
        out.append(np.where(least == never, -1, least % len(among)))
        rank = np.where(rank == least[owner], never, rank)
    return out[0], out[1]


def deal(df: DataFrame, shard_chars: int, vocabulary: int, most_hot: int = 1_000_000) -> tuple[DataFrame, tuple[int, float, np.ndarray], int]:
    """``df`` (``doc_id, ids, terms, items, tokens, chars, h``) with its ``shard``; the figures for ``Index`` over all items; the number of shards.

    Shards are cut from the order of the documents' rarest shared term, then their second; one that gets over twice
    ``shard_chars`` (very many documents alike) is divided by digest. What comes to the driver is a count for each term of
    the vocabulary. Divided shards are few and sent to every task up to ``most_hot``, else joined.
    """
    kind = _kind(vocabulary)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(vocabulary, np.int64)
        for b in batches:
            count += np.bincount(_flat(b.column(0), kind)[0], minlength=vocabulary)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(count[own], pa.int64())], names=["k", "n"])

    among = np.zeros(vocabulary, np.int64)
    for r in df.select("terms").mapInArrow(frequencies, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        among[r.k] = r.n
    whole = df.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("items", "tokens", "chars")]).first()
    stats = (whole["items"], whole["tokens"] / max(1, whole["items"]), among)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, second = rarest(*_flat(b.column(2), kind), among)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(5), b.column(6), pa.array(first), pa.array(second)], names=["doc_id", "ids", "chars", "h", "first", "second"])

    keyed = cut(df.mapInArrow(keys, "doc_id long, ids binary, chars long, h long, first long, second long"))
    per = keyed.groupBy("first").agg(F.sum("chars").alias("size"))
    # at most one row for each term of the vocabulary, so that one window and a broadcast are bounded
    start = per.withColumn("start", F.sum("size").over(Window.orderBy("first")) - F.col("size"))
    # what no term places is placed by digest
    place = F.pmod(F.when(F.col("first") < 0, F.col("h")).otherwise(F.xxhash64("second")), F.lit(1 << 30)) / (1 << 30)
    placed = keyed.join(F.broadcast(start), "first").withColumn("at", F.floor((F.col("start") + place * F.col("size")) / shard_chars)).select("doc_id", "ids", "chars", "h", "at")
    shards = whole["chars"] // shard_chars + 1
    hot = placed.groupBy("at").agg(F.sum("chars").alias("n")).filter(F.col("n") > 2 * shard_chars).select("at", F.ceil(F.col("n") / shard_chars).alias("many"))
    hot = cut(hot)
    joined = placed.join(F.broadcast(hot), "at", "left") if hot.count() <= most_hot else hot_join(placed, hot, ["at"], ["h"], "left")
    part = F.pmod("h", F.coalesce("many", F.lit(1)))
    extra = int(hot.agg(F.coalesce(F.sum(F.col("many") - 1), F.lit(0)).alias("n")).first().n)
    return joined.select("doc_id", "ids", (part * shards + F.col("at")).alias("shard")), stats, shards + extra


def _kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def pack_documents(df: DataFrame, doc_id: str, text: str, capacity: int = 2048, shard_chars: int = 4_000_000, file: str = DEFAULT_FILE, most_tasks: int = 20_000) -> DataFrame:
    """The containers' contents, one row ``SCHEMA`` for each item of each container, in filling order.

    An item is a document or, where its text has more than ``capacity`` tokens, one of its parts ``from_token`` to
    ``to_token``, all but the last of full size. A shard gets about ``shard_chars`` code points, whatever the table's size.
    Documents of null or empty text have no tokens and no row; a repeated ``doc_id`` is packed as often as it occurs; a
    null one is packed too. Other columns are ignored. Building the result runs jobs: token ids are materialised, and terms
    are counted. At most ``most_tasks`` tasks share the shards.
    """
    content = Path(file).read_bytes()
    vocabulary = load(content).n_vocab
    kind = _kind(vocabulary)
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).filter("length(t) > 0")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(content)
        for b in batches:
            ids = [enc.encode_to_numpy(t, disallowed_special=()) for t in b.column(1).to_pylist()]
            items = [_parts(x, capacity) for x in ids]
            # a term counts once for each part that has it
            terms = [np.sort(np.concatenate([np.unique(x) for x in own])) if len(own) > 1 else np.unique(own[0]) for own in items]
            blob = lambda rows: pa.array([x.astype(kind).tobytes() for x in rows], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), blob(ids), blob(terms), pa.array([len(x) for x in items], pa.int64()), pa.array([len(x) for x in ids], pa.int64()), b.column(2), b.column(3)],
                names=["doc_id", "ids", "terms", "items", "tokens", "chars", "h"],
            )

    encoded = source.select("doc_id", "t", F.length("t").cast("long").alias("chars"), F.xxhash64("doc_id", "t").alias("h"))
    dealt, stats, shards = deal(cut(encoded.mapInArrow(encode, "doc_id long, ids binary, terms binary, items long, tokens long, chars long, h long")), shard_chars, vocabulary)

    def fill(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "ids"], kind="stable")
        items, tokens = [], []
        for d, t in zip(pdf["doc_id"], pdf["ids"]):
            parts = _parts(np.frombuffer(t, kind), capacity)
            for k, own in enumerate(parts):
                items.append((d, k + 1, len(parts), k * capacity, k * capacity + len(own), len(own)))
                tokens.append(own)
        rows = []
        for c, own in enumerate(pack([x[5] for x in items], tokens, capacity, stats)):
            rows += [((int(key[0]) << 24) + c, p, *items[i]) for p, i in enumerate(own, 1)]
        return pd.DataFrame(rows, columns=[f.split()[0] for f in SCHEMA.split(", ")])

    # a task gets few shards: what they cost is computing, which no count of bytes tells; tasks stay in a number to schedule
    return dealt.repartition(min(shards, most_tasks), "shard").groupBy("shard").applyInPandas(fill, SCHEMA)


def fill_report(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: ``containers, items, tokens, fill`` (tokens over room) and ``least_tokens`` of a container; an empty result for no containers."""
    per = packed.groupBy("container_id").agg(F.count(F.lit(1)).alias("items"), F.sum("n_tokens").alias("tokens"))
    total = per.agg(F.count(F.lit(1)).alias("containers"), F.sum("items").alias("items"), F.sum("tokens").alias("tokens"), F.min("tokens").alias("least_tokens"))
    return total.filter("containers > 0").withColumn("fill", F.col("tokens") / (F.col("containers") * capacity))
