"""Jaccard join on word shingles with token-combination prefixes, and the groups that its links make.

Tokens are the 64-bit hashes of 5-word shingles. Tokens that several documents hold are of the frequent class: all tokens
are counted, packed into short differences, and a bitmap of those that ``FREQUENT`` documents or more hold is sent to all
tasks (of ``MAP_BITS`` bits at most, with room for one token in eight; where there are more, the bar is raised). The order
of tokens is: rare ones by hash, then frequent ones by hash. A document's prefix is extended until no partner within the
threshold can avoid all of its signatures: a signature is a single rare token, or a combination of two frequent tokens of
one bin. Which tokens count as frequent changes the work, never the links.

Equal sets are one class from the start, so copies cost nothing. A first round links most of each group of near copies:
classes that share two of their smallest tokens with one hub are compared with it. After that, a signature only matters
where its holders are still in different components. Holders of a rare token are few and are compared with one another;
holders of a combination are first compared with a hub, and then, if that leaves several components, with one another:
small sketches of their sets prove most pairs too far apart, the others are compared exactly where they lie, unless links
found before have joined them, so that a task only puts out links that join components; lists with the same smallest holder go
to one task, as one list where that is less work, and those of very many holders are cut into blocks. So every link between two components is found, and what may be a link is compared exactly.

Null texts and texts without words have no shingles and link with nothing, not even with each other; their component is
their own doc_id. Repeated rows and ids are linked by their texts alone. A component in which all doc_ids are null has a
null component_id, else nulls are left out of the smallest. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.bitmap import Members, bitmap
from tidemark.llm.components import components
from tidemark.llm.frames import BROADCAST_BYTES, KEY, keyed, on_file, small, staged

SHINGLE = 5
#: A link needs intersection / union of at least this many hundredths.
PERCENT = 75
FREQUENT = 4
MAP_BITS = 27
BITS = 40
LOWEST = 4
LEVEL_TOKENS = 64
BATCH_TOKENS = 2 << 20
BUCKET_TOKENS = 2 << 20
LIST_ROWS = 1 << 19
BLOCK_ROWS = 4096
#: The sets of a block's members take no more than what may be broadcast.
BLOCK_BYTES = BROADCAST_BYTES
BLOCK_PART_ROWS = 1 << 16
BLOCK_PART_BYTES = 16 << 20
#: So many pairs that were too far apart are remembered in a task.
KNOWN_APART = 1 << 18

U64 = np.uint64


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row number in the batch and sorted distinct shingles."""
    hashes, at = tokens.words(batch.column("text"))
    for i, own in enumerate(tokens.distinct(*tokens.shingles(hashes, at, SHINGLE))):
        yield i, own


def _class(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _members(batches):
    for batch in batches:
        for piece in tokens.pieces(batch):
            sizes, classes, lowest = [], [], []
            for _, own in _sets(piece):
                sizes.append(len(own))
                classes.append(_class(own) if len(own) else None)
                lowest.append(own[:LOWEST].view(np.int64))
            made = [pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(lowest, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in (*KEY, "doc_id")], *made], [*KEY, "doc_id", "n", "class", "lowest"])


def _counted(n_buckets: int):
    """Sorted runs of shortened tokens, cut at bucket bounds, each as byte planes of its differences."""
    schema = pa.schema([("bucket", pa.int64()), ("first", pa.int64()), ("width", pa.int32()), ("data", pa.binary())])
    bounds = np.array([(b << BITS) // n_buckets for b in range(1, n_buckets)], U64)

    def packed(held):
        found = np.sort(np.concatenate(held)) >> U64(64 - BITS)
        cuts = [0, *np.searchsorted(found, bounds).tolist(), len(found)]
        rows = []
        for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if i < j:
                step = np.diff(found[i:j])
                width = max(1, (int(step.max(initial=0)).bit_length() + 7) // 8)
                planes = np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8)[:, :width].T)
                rows.append({"bucket": b, "first": int(found[i]), "width": width, "data": planes.tobytes()})
        return pa.RecordBatch.from_pylist(rows, schema)

    def run(batches):
        held, n, seen = [], 0, set()
        for batch in batches:
            for piece in tokens.pieces(batch):
                for _, own in _sets(piece):
                    if (name := _class(own)) not in seen:
                        seen.add(name)
                        held.append(own)
                        n += len(own)
                if n >= BATCH_TOKENS:
                    yield packed(held)
                    held, n = [], 0
        if n:
            yield packed(held)

    return run


def _often(least: int):
    schema = pa.schema([("token", pa.int64()), ("df", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        parts = []
        for first, width, data in zip(*(table.column(c) for c in ("first", "width", "data")), strict=True):
            planes = np.frombuffer(data.as_py(), np.uint8).reshape(width.as_py(), -1)
            step = np.zeros((planes.shape[1], 8), np.uint8)
            step[:, : len(planes)] = planes.T
            parts.append(np.cumsum(np.concatenate(([first.as_py()], step.view(np.int64).ravel()))))
        token, df = np.unique(np.concatenate(parts), return_counts=True)
        return pa.table([token[df >= least], df[df >= least]], schema)

    return run


def frequent(docs: DataFrame, total: int, least: int = FREQUENT, most: int = MAP_BITS) -> bytes:
    """A bitmap of the tokens that ``least`` or more rows hold, by the tokens' upper bits; of 2 ** ``most`` bits at most."""
    n = max(1, min(-(-total // BUCKET_TOKENS), 1 << 20))
    runs = docs.select("text").mapInArrow(_counted(n), "bucket long, first long, width int, data binary")
    found = staged(runs.groupBy("bucket").applyInArrow(_often(least), "token long, df long"), "frequent")
    # Counts of counts are few: a hundred thousand of them need five billion tokens.
    held, bar = 0, least
    for df, count in found.groupBy("df").count().orderBy(F.desc("df")).collect():
        held += count
        if 8 * held > 1 << most:
            bar = df + 1
            held -= count
            break
    return bitmap(found.where(F.col("df") >= bar).select("token"), held, most, BITS)


def _missing(n: int) -> int:
    """How many of its n tokens a document may miss in a partner."""
    return n - -(-PERCENT * n // 100)


def _level(n: int) -> int:
    """Documents of one level share a division into 2 ** (level + 2) bins; on level 0 tokens stay single."""
    return max(0, (n // LEVEL_TOKENS).bit_length() - 1)


def signatures(own: np.ndarray, common: np.ndarray, rare: bool = True, often: bool = True) -> np.ndarray:
    """Signatures of a sorted set of tokens; ``common``: which are frequent. Any two sets that can link share one."""
    n = len(own)
    need = _missing(n) + 1
    single = own[~common]
    if len(single) >= need:
        return single[:need] if rare else single[:0]
    out = [single] if rare else []
    if often:
        rest = own[common]
        for level in {_level(n), _level(-(-100 * n // PERCENT))}:
            if level == 0:
                out.append(tokens.mix(rest[: need - len(single)] + U64(1)))
                continue
            bins: dict[int, list] = {}
            found, bits = len(single), level + 2
            for token, b in zip(rest.tolist(), (tokens.mix(rest) >> U64(64 - bits)).tolist(), strict=True):
                held = bins.setdefault(b, [])
                held.append(token)
                found += len(held) > 1
                if found == need:
                    break
            pairs = np.array([p for held in bins.values() for p in combinations(sorted(held), 2)], U64).reshape(-1, 2)
            out.append(tokens.mix(tokens.mix(pairs[:, 0] + U64(level)) * U64(3) + pairs[:, 1]))
    return np.unique(np.concatenate(out)) if out else single[:0]


def _signed(sent, rare: bool):
    def run(batches):
        table, seen = Members(sent.value), set()
        for batch in batches:
            for piece in tokens.pieces(batch):
                found, ids, sizes = [], [], []
                for _, own in _sets(piece):
                    if not len(own) or (name := _class(own)) in seen:
                        continue
                    seen.add(name)
                    signs = signatures(own, table(own), rare, not rare)
                    if len(signs):
                        found.append(signs)
                        ids.append(int.from_bytes(name[:8], "big", signed=True))
                        sizes.append(len(own))
                if found:
                    count = [len(s) for s in found]
                    columns = [np.concatenate(found).view(np.int64), np.repeat(np.array(ids, np.int64), count), np.repeat(np.array(sizes, np.int32), count)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sign", "id", "n"])

    return run


def _pairs(batches):
    """Of a partition by sign: the pairs of classes of a sign that are in different components and fit in size, once each."""
    columns = ("sign", "id", "n", "label")
    held = {c: [] for c in columns}
    for batch in batches:
        for c in columns:
            held[c].append(batch.column(c).to_numpy())
    if not held["sign"]:
        return
    rows = {c: np.concatenate(h) for c, h in held.items()}
    order = np.lexsort((rows["id"], rows["sign"]))
    rows = {c: r[order] for c, r in rows.items()}
    fresh = np.concatenate(([True], (rows["sign"][1:] != rows["sign"][:-1]) | (rows["id"][1:] != rows["id"][:-1])))
    again = np.concatenate((rows["sign"][fresh][1:] == rows["sign"][fresh][:-1], [False]))
    again[1:] |= again[:-1].copy()
    sign, ids, n, label = (rows[c][fresh][again] for c in columns)
    # A pair is as many rows apart as its sign has classes at most.
    found, ahead = [np.zeros((0, 2), np.int64)], 1
    while (same := np.flatnonzero(sign[ahead:] == sign[:-ahead])).size:
        a, b = same, same + ahead
        small_n, large_n = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        fit = (label[a] != label[b]) & (100 * small_n.astype(np.int64) >= PERCENT * large_n.astype(np.int64))
        found.append(np.unique(np.stack((ids[a[fit]], ids[b[fit]]), 1), axis=0))
        ahead += 1
    pairs = np.unique(np.concatenate(found), axis=0)
    for i in range(0, len(pairs), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in pairs[i : i + (1 << 16)].T], ["a", "b"])


def _texts_as_sets(batches):
    for batch in batches:
        for piece in tokens.pieces(batch):
            sets = [own.view(np.int64) for _, own in _sets(piece)]
            flat = pa.array(np.concatenate(sets)) if sets else pa.array([], pa.int64())
            where = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([piece.column("class"), pa.ListArray.from_arrays(pa.array(where), flat)], ["class", "tokens"])


def _texts_as_own(batches):
    for batch in batches:
        for piece in tokens.pieces(batch):
            sets = [own.tobytes() for _, own in _sets(piece)]
            yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("class"), pa.array(sets, pa.binary())], ["id", "class", "tokens"])


def _sketch_bits(n: int) -> int:
    return max(64, 8 << n.bit_length())


def _sketch(own: np.ndarray) -> bytes:
    """A bit for the low bits of each token, in eight to sixteen bits a token."""
    held = np.zeros(_sketch_bits(len(own)), bool)
    held[(own & U64(len(held) - 1)).astype(np.int64)] = True
    return np.packbits(held, bitorder="little").tobytes()


def _texts_as_sketches(batches):
    for batch in batches:
        for piece in tokens.pieces(batch):
            sketches = [_sketch(own) for _, own in _sets(piece)]
            columns = [piece.column("id"), piece.column("class"), piece.column("n"), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "class", "n", "sketch"])


def most_shared(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """No fewer than the tokens that sets with these sketches and sizes share: a bit that only one has stands for a token it has alone."""
    bits, x, y = 8 * min(len(a), len(b)), int.from_bytes(a, "little"), int.from_bytes(b, "little")
    for size in range(max(len(a), len(b)).bit_length() + 2, bits.bit_length() - 1, -1):
        half = 1 << (size - 1)
        x, y = (v >> half | v & ((1 << half) - 1) if n * 8 > half else v for v, n in ((x, len(a)), (y, len(b))))
    return min(n_a - (x & ~y).bit_count(), n_b - (y & ~x).bit_count())


def _bounded(batches):
    for batch in batches:
        most = [most_shared(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("left", "right", "n_a", "n_b")), strict=True)]
        names = ["a", "b", "class_a", "class_b", "n_a", "n_b"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(most, pa.int64())], [*names, "most"])


def compared(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Written: the pairs (a, b) of ids with their classes and sizes, ``most`` tokens that both can have, and ``both``, the
    exact number, which is null where ``most`` is too few for a link. Small sketches of the sets give ``most``, so that the
    sets themselves are only moved for pairs that are close."""
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = staged(classes.join(wanted, "id").select(*KEY, "id", "class", "n"), "wanted")
    found = docs.join(small(wanted, 96), KEY).select("id", "class", "n", "text")
    found = staged(found.mapInArrow(_texts_as_sketches, "id long, class binary, n long, sketch binary"), "sketches")
    left = found.select(F.col("id").alias("a"), F.col("class").alias("class_a"), F.col("n").alias("n_a"), F.col("sketch").alias("left"))
    right = found.select(F.col("id").alias("b"), F.col("class").alias("class_b"), F.col("n").alias("n_b"), F.col("sketch").alias("right"))
    form = "a long, b long, class_a binary, class_b binary, n_a long, n_b long, most long"
    bounded = staged(pairs.join(left, "a").join(right, "b").mapInArrow(_bounded, form), "bounded")

    close = bounded.where(_linked("most")).select("class_a", "class_b").distinct()
    wanted = close.select(F.col("class_a").alias("class")).unionByName(close.select(F.col("class_b").alias("class"))).distinct()
    wanted = staged(classes.join(wanted, "class").select(*KEY, "class"), "wanted")
    sets = docs.join(small(wanted, 96), KEY).select("class", "text").mapInArrow(_texts_as_sets, "class binary, tokens array<long>")
    sets = staged(sets, "sets")
    left = sets.select(F.col("class").alias("class_a"), F.col("tokens").alias("left"))
    right = sets.select(F.col("class").alias("class_b"), F.col("tokens").alias("right"))
    exact = close.join(left, "class_a").join(right, "class_b")
    exact = exact.select("class_a", "class_b", F.size(F.array_intersect("left", "right")).cast("long").alias("both"))
    return staged(bounded.join(exact, ["class_a", "class_b"], "left"), "compared")


def _fits(a: str, b: str) -> Column:
    """Whether sets of these sizes can link."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _linked(both: str = "both") -> Column:
    return 100 * F.col(both) >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col(both))


def _edges(found: DataFrame) -> DataFrame:
    return found.where(_linked()).select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))


def _named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``label``: the component of a class, or the class itself if it has no links yet."""
    return rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _labels(edges: DataFrame) -> DataFrame:
    found = components(edges)
    return staged(found.select(_id("node").alias("id"), _id("label").alias("label")), "labels")


def links(docs: DataFrame, members: DataFrame, least: int = FREQUENT, most: int = MAP_BITS) -> DataFrame:
    """Labels of the classes that have links: node and label."""
    classes = members.where("n > 0").groupBy("class").agg(F.min(F.struct(*KEY)).alias("row"), F.first("n").alias("n"), F.first("lowest").alias("lowest"))
    classes = staged(classes.select("class", "row.*", "n", _id().alias("id"), "lowest"), "classes")

    # First round: it only has to link much, not all.
    low = classes.select("id", "n", F.explode("lowest").alias("sign"))
    hubs = low.groupBy("sign").agg(F.min(F.struct("id", "n")).alias("hub"), F.count(F.lit(1)).alias("held")).where("held > 1")
    near = low.join(hubs, "sign").where((F.col("id") != F.col("hub.id")) & _fits("n", "hub.n"))
    near = near.groupBy(F.col("hub.id").alias("a"), F.col("id").alias("b")).agg(F.count(F.lit(1)).alias("shared")).where("shared > 1")
    first = compared(docs, classes, staged(near.select("a", "b"), "first-pairs"))
    edges = staged(_edges(first), "edges")
    labels = small(_labels(edges), 32)

    total = members.agg(F.sum("n")).first()[0] or 0
    sent = docs.sparkSession.sparkContext.broadcast(frequent(docs, total, least, most))
    form = "sign long, id long, n int"
    # About a quarter of all tokens are in prefixes. A rare sign has few rows, so no partition grows with one sign.
    rare = _named(docs.select("text").mapInArrow(_signed(sent, True), form), labels)
    rare = rare.repartition(max(1, total // 4 // LIST_ROWS), "sign").mapInArrow(_pairs, "a long, b long")
    often = staged(docs.select("text").mapInArrow(_signed(sent, False), form), "combinations")
    star, joined = _combined(docs, classes, _named(often, labels))
    pairs = rare.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    done = [d.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) for d in (first, star)]
    pairs = staged(pairs.join(done[0].unionByName(done[1]).distinct(), ["a", "b"], "left_anti"), "pairs")
    found = compared(docs, classes, pairs)
    return components(staged(edges.unionByName(_edges(star)).unionByName(_edges(found)).unionByName(joined), "edges"))


def _combined(docs: DataFrame, classes: DataFrame, signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of signs that many classes may hold: the comparisons with hubs, and links (a, b) of classes that join what hubs left apart."""
    mixed = signed.groupBy("sign").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    signed = signed.join(small(staged(mixed.select("sign"), "mixed"), 16), "sign").distinct()
    # Sizes a factor of 4/3 apart make one band; a list holds two bands next to each other, so that it has all fitting pairs.
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT)))
    signed = staged(signed.withColumn("sizes", F.explode(F.array(band, band + 1))), "lists")
    lists = signed.groupBy("sign", "sizes").agg(F.min(F.struct("id", "n", "label")).alias("hub"), F.min("label").alias("low"), F.max("label").alias("high"))
    lists = lists.where("low != high").select("sign", "sizes", F.col("hub.id").alias("a"), F.col("hub.n").alias("n_a"), F.col("hub.label").alias("label_a"))
    rows = staged(signed.join(lists, ["sign", "sizes"]), "hubs")
    star = rows.where((F.col("label_a") != F.col("label")) & _fits("n", "n_a")).select("a", F.col("id").alias("b")).distinct()
    star = compared(docs, classes, staged(star, "star"))

    # Links with hubs join components; where a list still has several, its members are compared by sketches.
    moved = star.where(_linked()).join(rows.select(F.col("id").alias("a"), F.col("label").alias("from_a")).distinct(), "a")
    moved = moved.join(rows.select(F.col("id").alias("b"), F.col("label").alias("from_b")).distinct(), "b")
    to = components(staged(moved.select(F.col("from_a").alias("a"), F.col("from_b").alias("b")).distinct(), "moves"))
    to = small(staged(to.select(F.col("node").alias("label"), F.col("label").alias("to")), "to"), 32)
    rows = rows.select("sign", "sizes", "id", "n", "label").join(to, "label", "left").withColumn("label", F.coalesce("to", "label")).drop("to")
    lists = rows.groupBy("sign", "sizes").agg(F.min("id").alias("hub"), F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("held"), F.sum("n").alias("sum"))
    lists = staged(lists.where("low != high").select("sign", "sizes", "hub", "held", "sum"), "open-lists")
    rows = staged(rows.join(small(lists, 48), ["sign", "sizes"]), "open")
    wanted = staged(classes.join(rows.select("id").distinct(), "id").select(*KEY, "id", "class"), "wanted")
    found = docs.join(small(wanted, 96), KEY).select("id", "class", "text")
    found = staged(found.mapInArrow(_texts_as_own, "id long, class binary, tokens binary"), "own-sets")
    met = staged(_met(rows, lists), "met")
    many, held = met.agg(F.count(F.lit(1))).first()[0], met.select("unit", "id", "n").distinct().agg(F.sum("n")).first()[0]
    parts = max(1, many // BLOCK_PART_ROWS, 8 * (held or 0) // BLOCK_PART_BYTES)
    met = met.select(F.pmod(F.xxhash64("unit"), F.lit(parts)).alias("part"), "sign", "id", "label")
    sets = met.select("part", "id").distinct().join(found, "id").select("part", "id", "class", "tokens")
    return star, met.unionByName(sets, allowMissingColumns=True).repartition(parts, "part").mapInArrow(_near_links, "a binary, b binary")


def _met(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """Who meets whom: members (sign, id, label, n) of open lists cut into blocks, and ``unit``, equal for what shares members.

    Lists that share members mostly share the smallest too, their hub: what many texts repeat makes hundreds of lists of nearly
    the same holders. Lists of a hub become one of all their members if that takes fewer comparisons than each on its own. It
    has pairs that share no list as well; what of them is a link is one whichever way it is found. Else they are only dealt to one
    task, so that their sets go there once.
    """
    of = ["hub", "sizes"]
    members = staged(rows.select(*of, "id", "n", "label").distinct(), "members-of-hubs")
    met = members.groupBy(*of).agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("all"))
    met = met.join(lists.groupBy(*of).agg(F.sum(F.col("held") * F.col("held")).alias("work")), of)
    met = staged(met.select(*of, "many", "all", (F.col("many") * F.col("many") <= F.col("work")).alias("whole")), "hubs-met")
    chunks = lambda n, size: F.greatest(F.ceil(F.col(n) / BLOCK_ROWS), F.ceil(8 * F.col(size) / BLOCK_BYTES)).alias("chunks")
    whole = members.join(met.where("whole"), of).select(*of, F.lit(None).cast("long").alias("sign"), "id", "n", "label", chunks("many", "all"))
    each = rows.join(met.where("NOT whole"), of).select(*of, "sign", "id", "n", "label", chunks("held", "sum"))
    rows = whole.unionByName(each)
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks"))
    block = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda c: F.struct(F.least(chunk, c).alias("x"), F.greatest(chunk, c).alias("y")))
    rows = rows.withColumn("block", F.explode(block))
    return rows.select(F.xxhash64(*of, "block").alias("unit"), F.xxhash64("sign", *of, "block").alias("sign"), "id", "label", "n")


def _near_links(batches):
    """Of a partition by unit: links of members of a list in different components, exactly. Members that links of this task have joined aren't compared.

    Rows without a list have id, class and set of all members.
    """
    signs, labels, ids, named, sets, sketches = [], [], [], {}, {}, {}

    def known(rows):
        for x, name, own in rows:
            if name not in sets:
                sets[name] = np.frombuffer(own, U64)
                named.setdefault(x, []).append(name)

    for batch in batches:
        own = batch.filter(pc.is_valid(batch.column("tokens")))
        known(zip(*(own.column(c).to_pylist() for c in ("id", "class", "tokens")), strict=True))
        batch = batch.filter(pc.is_valid(batch.column("sign")))
        for held, c in ((signs, "sign"), (labels, "label"), (ids, "id")):
            held.append(batch.column(c).to_numpy())
    if not signs:
        return
    sign, label, rows, joined, apart, found = np.concatenate(signs), np.concatenate(labels), np.concatenate(ids), {}, set(), []
    # Classes of one id, of which there may be several, are members each.
    many = np.array([len(named[x]) for x in rows.tolist()], np.int64)
    names = [name for x in rows.tolist() for name in named[x]]
    sign, label = np.repeat(sign, many), np.repeat(label, many)

    def root(x: int) -> int:
        while (up := joined.get(x, x)) != x:
            joined[x] = x = joined.get(up, up)
        return x

    def linked(a: bytes, b: bytes) -> bool:
        pair = (a, b) if a < b else (b, a)
        if pair in apart:
            return False
        n = len(sets[a]) + len(sets[b])
        both = n - len(np.unique(np.concatenate((sets[a], sets[b]))))
        if 100 * both >= PERCENT * (n - both):
            return True
        if len(apart) >= KNOWN_APART:
            apart.clear()
        apart.add(pair)
        return False

    sizes = np.array([len(sets[name]) for name in names], np.int64)
    order = np.lexsort((sizes, sign))
    sign = sign[order]
    heads = np.flatnonzero(np.concatenate(([True], sign[1:] != sign[:-1], [True])))
    for i, j in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
        # In order of size, so that what fits is near; sketches of a run are folded to the shortest of it.
        own, size = [names[k] for k in order[i:j]], sizes[order[i:j]]
        of = np.array([root(x) for x in label[order[i:j]].tolist()], np.int64)
        # Members of the commonest component need no comparison with each other, so the others are compared with all.
        roots, which, times = np.unique(of, return_inverse=True, return_counts=True)
        if len(roots) < 2:
            continue
        for name in own:
            if name not in sketches:
                sketches[name] = np.frombuffer(_sketch(sets[name]), U64)
        table = np.stack([np.bitwise_or.reduce(sketches[name].reshape(-1, len(sketches[own[0]])), axis=0) for name in own])
        # Bits that only one has: its own less those of both.
        bits = np.bitwise_count(table).sum(1, dtype=np.int64)
        for k in np.flatnonzero(which != times.argmax()).tolist():
            fit = slice(np.searchsorted(size, -(-PERCENT * size[k] // 100)), np.searchsorted(size, 100 * size[k] // PERCENT, "right"))
            other = np.flatnonzero(of[fit] != of[k]) + fit.start
            both = np.bitwise_count(table[k] & table[other]).sum(1, dtype=np.int64)
            most = np.minimum(size[k] - bits[k], size[other] - bits[other]) + both
            near = np.flatnonzero(100 * most >= PERCENT * (size[k] + size[other] - most))
            for m in other[near[np.argsort(-most[near], kind="stable")]].tolist():
                if of[m] != of[k] and linked(own[k], own[m]):
                    found.append((own[k], own[m]))
                    gone, to = int(of[k]), int(of[m])
                    joined[gone] = to
                    of[of == gone] = to
    for i in range(0, len(found), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found[i : i + (1 << 16)], strict=True)], ["a", "b"])


def _id(column: str = "class") -> Column:
    """The first eight bytes of a class, as the number that _signed makes of them. Equal ids only mean more comparisons."""
    return F.conv(F.hex(F.substring(column, 1, 8)), 16, -10).cast("long")


def near_groups(docs: DataFrame, least: int = FREQUENT, most: int = MAP_BITS) -> DataFrame:
    """A row per document: KEY, doc_id, n_shingles, component_id, and group, which tells components with null ids apart too."""
    docs = on_file(docs)
    rows = keyed(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    members = staged(rows.mapInArrow(_members, "at_file long, at_row long, doc_id long, n long, class binary, lowest array<long>"), "members")
    labels = links(rows.select(*KEY, "text"), members, least, most)
    sets = members.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("low"))
    sets = sets.join(labels, sets["class"] == labels["node"], "left").select("class", "low", F.coalesce("label", "class").alias("label"))
    sets = staged(sets, "sets-labels")
    lowest = sets.groupBy("label").agg(F.min("low").alias("component_id"))
    named = sets.join(lowest, "label").select("class", "component_id", F.col("label").alias("group"))
    found = members.drop("lowest").join(named, "class", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(*KEY, "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "group")
