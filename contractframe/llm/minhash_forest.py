"""Near-duplicate documents by MinHash signatures in an LSH forest.

A document is the set of its distinct runs of five words. Documents of equal sets are one class; classes are
linked when their sets overlap by 75 of 100, and documents linked by any chain share a component.

- Forest: a signature of ``HASHES`` minima is read in ``TREES`` rotated orders. Each order is sorted over the
  whole table by range partitioning, so that a crowded region spreads over tasks. Rows that share the first
  ``DEPTH`` minima are a region; two of similarity 0.75 share none in 2 of a million cases.
- Neighbours: in each sorted order the rows next to each other share the longest prefix, however deep the
  region is; each class tries the ``PARTNERS`` neighbours met most often and deepest. Their full sets decide.
- The rest, exactly, in one pass: a region whose classes are already one component needs no more pairs. In every other
  one each class outside its largest component meets all classes of the region, in blocks of bounded size. A block
  first finds its classes that have a partner in another component by whole signatures (four standard errors below
  the threshold); only these bring their texts to it, all their full sets meet there, and the block reports no more links
  than join its components. Nothing is lost to the choice of partners, and no pair becomes a row before it is a link.

Links, components and signatures stay in tables; the driver sees counts alone.

Defined results: case of A to Z is ignored; a text of one to four words is one run; null and empty texts have
no set, are linked with nothing and are kept; equal rows share a component, and ``keep_one`` keeps one of
them; null ids sort last, so a component holding an id never takes null; an empty table gives no rows; other
input columns are ignored (``keep_one`` keeps them).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractframe.llm.common import batches, discard, ground, materialize, row_key, ship_package, slices
from contractframe.llm.words import LOW, mixed, range_hashes, rolling

HASHES, TREES, DEPTH, RUN = 96, 24, 3, 5
PARTNERS = 3  # tried first; the rest is done exactly
LIKELY = 0.57  # agreement of signatures; four standard errors below 0.75
_OUTSIDE, _CHUNK = 512, 2048  # classes of a region that meet in one block; each ``_LONG`` runs of a longer one count as a class
_LONG = 500
_LAST = (1 << 63) - 1  # stands for a null id in class names
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_FACTORS = np.random.default_rng(41).integers(0, 1 << 63, HASHES, dtype="uint64") * np.uint64(2) + np.uint64(1)


def _sets(texts: list[str | None]):
    """All sets in a row, each sorted: (hashes, the text each belongs to)."""
    raw = [t.encode().lower() if t else b"" for t in texts]
    data = np.frombuffer(b" ".join([*raw, b""]), "uint8")  # a space after each text
    space = _SPACES[data]
    turns = np.flatnonzero(space[1:] != space[:-1]) + 1
    turns = turns if not len(space) or space[0] else np.concatenate([[0], turns])
    first, stop = turns[::2], turns[1::2]
    limits = np.cumsum([len(r) + 1 for r in raw])
    owner = np.searchsorted(limits, first, side="right")
    sizes = np.bincount(owner, minlength=len(raw))
    values = range_hashes(data, first, stop - first, 0)
    found, own = np.zeros(0, "uint64"), np.zeros(0, "int64")
    if len(values) >= RUN:
        inside = owner[: len(owner) - RUN + 1] == owner[RUN - 1 :]
        found, own = mixed(rolling(values, RUN, LOW)[inside]), owner[: len(inside)][inside]
    short = np.flatnonzero((sizes > 0) & (sizes < RUN))
    if len(short):
        at = np.cumsum(sizes) - sizes
        whole = [mixed(rolling(values[at[i] : at[i] + sizes[i]], int(sizes[i]), LOW) + np.uint64(sizes[i]))[0] for i in short]
        found, own = np.concatenate([found, np.array(whole, "uint64")]), np.concatenate([own, short])
        order = np.argsort(own, kind="stable")
        found, own = found[order], own[order]
    ends = np.cumsum(np.bincount(own, minlength=len(raw))).tolist()
    for a, b in zip([0, *ends], ends):
        found[a:b].sort()
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (own[1:] != own[:-1])
    return found[new], own[new]


def signatures(narrow: DataFrame) -> DataFrame:
    """doc_id, _k, n (size of the set), s1 and s2 (hash of the set), sig (16 bits of each of its minima)."""
    import pyarrow as pa

    ship_package(narrow.sparkSession)

    def sign(stream):
        for batch in stream:
            for part in slices(batch, "text", 1 << 20):
                found, own = _sets(part.column("text").to_pylist())
                rows = part.num_rows
                n = np.bincount(own, minlength=rows)
                some = np.flatnonzero(n)
                starts = (np.cumsum(n) - n)[some]
                sums, least = np.zeros((2, rows), "uint64"), np.zeros((rows, HASHES), "uint16")
                if len(some):
                    sums[0, some] = np.add.reduceat(mixed(found), starts)
                    sums[1, some] = np.add.reduceat(mixed(found ^ np.uint64(0x5851F42D4C957F2D)), starts)
                    turned = np.empty_like(found)
                    for j, factor in enumerate(_FACTORS):
                        np.multiply(found, factor, out=turned)
                        least[some, j] = np.minimum.reduceat(turned, starts) >> np.uint64(32) & np.uint64(0xFFFF)
                yield batches({
                    "doc_id": (part.column("doc_id"), None), "_k": (part.column("_k"), None), "n": (pa.array(n.astype("int64")), None),
                    "s1": (pa.array(sums[0].view("int64")), None), "s2": (pa.array(sums[1].view("int64")), None),
                    "sig": (_binary(least), None),
                })

    return narrow.mapInArrow(sign, "doc_id bigint, _k bigint, n bigint, s1 bigint, s2 bigint, sig binary")


def _binary(rows: np.ndarray):
    """One binary value per row of a matrix."""
    import pyarrow as pa

    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype="int32") * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _matrix(column, kind: str = "uint16") -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _name(d: str | Column, k: str | Column) -> Column:
    return F.struct(F.coalesce(F.col(d) if isinstance(d, str) else d, F.lit(_LAST)).alias("d"), (F.col(k) if isinstance(k, str) else k).alias("k"))


def _classes(signed: DataFrame) -> DataFrame:
    """One row per distinct set, named by its smallest document."""
    return signed.where("n > 0").groupBy("n", "s1", "s2").agg(F.min(_name("doc_id", "_k")).alias("node"), F.first("sig").alias("sig"))


def _neighbours(classes: DataFrame) -> DataFrame:
    """The sorted orders of the forest, read side by side.

    Rows with x and y are neighbours of one region (y before x) and their common depth; rows with y null are
    classes of a region of two or more, or of one that may go on in the next range.
    """
    import pyarrow as pa

    stride = HASHES // TREES

    def plant(stream):
        for batch in stream:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                least = _matrix(part.column("sig")).astype("uint64")
                for tree in range(TREES):
                    p, q = np.full(part.num_rows, tree, "uint64"), np.zeros(part.num_rows, "uint64")
                    for i in range(DEPTH):
                        p = p << np.uint64(16) | least[:, (tree * stride + i) % HASHES]
                    for i in range(DEPTH, DEPTH + 4):
                        q = q << np.uint64(16) | least[:, (tree * stride + i) % HASHES]
                    # Signed numbers of the same order.
                    q = q ^ np.uint64(1 << 63)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(p.view("int64")), pa.array(q.view("int64")), part.column("d"), part.column("k")], names=["p", "q", "d", "k"]
                    )

    def walk(stream):
        held, first = None, True
        for batch in stream:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy() for c in ("p", "q", "d", "k")]
            p, q, d, k = new if held is None else [np.concatenate(x) for x in zip(held[0], new)]
            same = p[1:] == p[:-1]
            member = np.zeros(len(p), bool)
            member[1:] |= same
            member[:-1] |= same
            if first:
                member[0] = True
            if held is not None:
                member[0] |= held[1]
            yield from told(p, q, d, k, same, member[:-1])
            held, first = ([x[-1:] for x in (p, q, d, k)], bool(member[-1])), False
        if held:
            yield from told(*held[0], np.zeros(0, bool), np.ones(1, bool))

    def told(p, q, d, k, same, member):
        at, m = np.flatnonzero(same) + 1, np.flatnonzero(member)
        apart = (q[at] ^ q[at - 1]).view("uint64")
        depth = DEPTH + (apart < 1 << 48).astype("int64") + (apart < 1 << 32) + (apart < 1 << 16) + (apart == 0)
        lone = pa.nulls(len(m), pa.int64())
        for values in ((p[at], d[at], k[at], pa.array(d[at - 1]), pa.array(k[at - 1]), depth), (p[m], d[m], k[m], lone, lone, np.zeros(len(m), "int64"))):
            yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in values], names=["p", "xd", "xk", "yd", "yk", "depth"])

    planted = classes.select(F.col("node.d").alias("d"), F.col("node.k").alias("k"), "sig").mapInArrow(plant, "p bigint, q bigint, d bigint, k bigint")
    ordered = planted.repartitionByRange("p", "q", "d", "k").sortWithinPartitions("p", "q", "d", "k")
    return ordered.mapInArrow(walk, "p bigint, xd bigint, xk bigint, yd bigint, yk bigint, depth bigint")


def _first_pairs(neighbours: DataFrame) -> DataFrame:
    """Of each class the neighbours met most often and deepest, as pairs x < y; those met once and not deep are left to the rest."""
    met = neighbours.where("yd IS NOT NULL").select(F.struct(F.col("xd").alias("d"), F.col("xk").alias("k")).alias("x"), F.struct(F.col("yd").alias("d"), F.col("yk").alias("k")).alias("y"), "depth")
    strength = met.groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.sum("depth").alias("strength"))
    strength = strength.where(F.col("strength") >= 2 * DEPTH)
    both = strength.unionByName(strength.select(F.col("y").alias("x"), F.col("x").alias("y"), "strength"))
    # A class has at most two neighbours in each order, so the window is small for every class.
    best = both.withColumn("_r", F.row_number().over(Window.partitionBy("x").orderBy(F.desc("strength"), "y"))).where(F.col("_r") <= PARTNERS)
    return best.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _packed_texts(narrow: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of the wanted classes, compressed before they are shuffled; one row per class."""
    import pyarrow as pa

    def press(stream):
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for batch in stream:
            for part in slices(batch, "text"):
                packed = [press.compress((t or "").encode()) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("d"), part.column("k"), pa.array(packed, pa.binary())], names=["d", "k", "z"])

    named = narrow.where(F.length("text") > 0).select(F.coalesce("doc_id", F.lit(_LAST)).alias("d"), F.col("_k").alias("k"), "text")
    packed = named.mapInArrow(press, "d bigint, k bigint, z binary")
    asked = wanted.select(F.col("node.d").alias("_d"), F.col("node.k").alias("_k"))
    own = packed.join(asked, (F.col("d") == F.col("_d")) & (F.col("k") == F.col("_k")))
    return own.groupBy(F.struct("d", "k").alias("node")).agg(F.first("z").alias("z"))


def _links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets overlap by at least ``percent`` of their union."""
    import pyarrow as pa

    def confirm(stream):
        import zstandard

        open_, known = zstandard.ZstdDecompressor(), {}

        def own_set(z):
            if z not in known:
                if len(known) > 500:
                    known.clear()
                known[z] = _sets([open_.decompress(z).decode()])[0]
            return known[z]

        for batch in stream:
            keep = []
            for a, b in zip(batch.column("zx").to_pylist(), batch.column("zy").to_pylist()):
                x, y = own_set(a), own_set(b)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    left, right = (texts.select(F.col("node").alias(f"n{s}"), F.col("z").alias(f"z{s}")) for s in "xy")
    joined = pairs.join(left, F.col("x") == F.col("nx")).select("x", "y", "zx").join(right, F.col("y") == F.col("ny")).select("x", "y", "zx", "zy")
    node = "struct<d: bigint, k: bigint>"
    return joined.mapInArrow(confirm, f"x {node}, y {node}")


def components(links: DataFrame) -> DataFrame:
    """node, label (and the last label but one): the smallest node that chains of links (x, y) reach, for every node with a link.

    Labels take the smallest label next to them and then the label of their label, until none changes.
    """
    both = materialize(links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels = materialize(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        seen = labels.select(F.col("node").alias("y"), F.col("label").alias("l"))
        near = both.join(seen, "y").groupBy(F.col("x").alias("node")).agg(F.min("l").alias("m"))
        lower = labels.join(near, "node").select("node", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        lower = materialize(lower, "labels")
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("l"))
        before, labels = labels, materialize(lower.join(jump, "label").select("node", F.col("l").alias("label"), "old"), "labels")
        discard(before, lower)
        if labels.where("label < old").isEmpty():
            discard(both)
            return labels


def _rest_pairs(members: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links x, y between different components that share a region, stored: in each block as many as join its components."""
    told = members.join(labels.select("node", "label"), "node", "left").select("p", "node", F.coalesce("label", "node").alias("label"))
    told = materialize(told, "regions")
    mixed_regions = told.groupBy("p").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a < _b").select(F.col("p").alias("_p"))
    open_ = told.join(mixed_regions, F.col("p") == F.col("_p")).select("p", "node", "label")
    open_ = materialize(open_.join(classes.select("node", "sig", F.col("n").alias("size")), "node"), "open-regions")
    discard(told)
    rows = materialize(_blocks(open_).mapInArrow(_with_partners(percent), _PLACED), "partners")
    discard(open_)
    worded = rows.join(texts.select(F.col("node.d").alias("_d"), F.col("node.k").alias("_k"), "z"), (F.col("d") == F.col("_d")) & (F.col("k") == F.col("_k"))).drop("_d", "_k")
    met = _together(worded).mapInArrow(_joining(percent), "xd bigint, xk bigint, yd bigint, yk bigint")
    x, y = F.struct(F.col("xd").alias("d"), F.col("xk").alias("k")), F.struct(F.col("yd").alias("d"), F.col("yk").alias("k"))
    links = materialize(met.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).distinct(), "near-links")
    discard(rows)
    return links


_PLACED = "p bigint, i int, j int, role int, d bigint, k bigint, ld bigint, lk bigint"
#: Roles in a block: of the main component; outside it, to meet the others; both, where one block is the whole region; outside, to be met.
_MAIN, _OUT, _ALONE, _MET = range(4)
_MEET, _MEET_ONCE = 1, 2  # _MEET_ONCE: these two meet in a second block too, so the smaller name decides
_PAIRS = np.zeros((4, 4), "int8")
_PAIRS[_ALONE, [_MAIN, _ALONE]] = _PAIRS[_MAIN, _ALONE] = _PAIRS[_OUT, _MAIN] = _PAIRS[_MAIN, _OUT] = _MEET
_PAIRS[_OUT, _MET] = _PAIRS[_MET, _OUT] = _MEET_ONCE


def _blocks(open_: DataFrame) -> DataFrame:
    """The classes of open regions, dealt to blocks (p, i, j) where each meets the ones it has to; rows of a block follow each other."""
    weight = F.greatest(F.lit(1.0), F.col("size") / _LONG)
    by_label = open_.groupBy("p", "label").agg(F.count("*").alias("c"), F.sum(weight).alias("w"))
    shape = by_label.groupBy(F.col("p").alias("_p")).agg(F.max(F.struct("c", "label", "w")).alias("main"), F.sum("c").alias("m"), F.sum("w").alias("w"))
    parts = lambda w, c, most: F.greatest(F.lit(1), F.least(F.ceil(w / most), c)).cast("int")
    shape = shape.select(
        "_p", F.col("main.label").alias("main"), parts(F.col("w") - F.col("main.w"), F.col("m") - F.col("main.c"), _OUTSIDE).alias("_i"),
        parts(F.col("w"), F.col("m"), _CHUNK).alias("_j"),
    )
    rows = open_.join(shape, F.col("p") == F.col("_p"))
    out, hash_ = F.col("label") != F.col("main"), F.xxhash64("node")
    i, j = F.pmod(hash_, "_i").cast("int"), F.pmod(F.shiftright(hash_, 20), "_j").cast("int")
    place = lambda i, j, role: F.struct(i.alias("i"), j.alias("j"), role.cast("int").alias("role"))
    zero, role = F.lit(0), lambda other: F.when(out, F.lit(other)).otherwise(F.lit(_MAIN))
    meets = F.transform(F.sequence(zero, F.col("_j") - 1), lambda b: place(i, b, F.lit(_OUT)))
    met = F.transform(F.sequence(zero, F.col("_i") - 1), lambda b: place(b, j, role(_MET)))
    places = F.when((F.col("_i") == 1) & (F.col("_j") == 1), F.array(place(zero, zero, role(_ALONE)))).otherwise(F.when(out, F.concat(meets, met)).otherwise(met))
    placed = rows.select("p", F.explode(places).alias("at"), "node", "label", "size", "sig")
    return _together(placed.select(
        "p", "at.i", "at.j", "at.role", F.col("node.d").alias("d"), F.col("node.k").alias("k"), F.col("label.d").alias("ld"), F.col("label.k").alias("lk"), "size", "sig"
    ))


def _together(placed: DataFrame) -> DataFrame:
    return placed.repartition("p", "i", "j").sortWithinPartitions("p", "i", "j")


def _whole_blocks(stream):
    """Batches cut where blocks end, and the number of the block in its batch for every row."""
    import pyarrow as pa

    held = None
    for batch in stream:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        keys = [batch.column(c).to_numpy() for c in ("p", "i", "j")]
        turns = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        last = int(turns[-1]) if len(turns) else 0
        if last:
            yield batch.slice(0, last), np.searchsorted(turns, np.arange(last), side="right")
        held = batch.slice(last)
    if held is not None:
        yield held, np.zeros(held.num_rows, "int64")


def _meeting(role: np.ndarray, names: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of these rows of a block meet: pairs of different components, each in one block of a region."""
    kind = _PAIRS[role[a], role[b]]
    good = (kind > 0) & (names[2:, a] != names[2:, b]).any(axis=0)
    once = np.flatnonzero(good & (kind == _MEET_ONCE))
    if len(once):
        first = role[a[once]] == _OUT
        x, y = np.where(first, a[once], b[once]), np.where(first, b[once], a[once])
        good[once] = (names[0, x] < names[0, y]) | (names[0, x] == names[0, y]) & (names[1, x] < names[1, y])
    return good


def _with_partners(percent: int):
    """Rows of a block that have a partner in it, as far as signatures tell."""
    lead = [t * (HASHES // TREES) + i for t in range(TREES) for i in range(DEPTH)]

    def find(stream):
        for batch, block in _whole_blocks(stream):
            names = np.stack([batch.column(c).to_numpy() for c in ("d", "k", "ld", "lk")])
            role, size, sigs = batch.column("role").to_numpy(), batch.column("size").to_numpy(), _matrix(batch.column("sig"))
            low, tree = np.ascontiguousarray((sigs & 0xFF).astype("uint8")), batch.column("p").to_numpy() >> 16 * DEPTH
            found = np.zeros(batch.num_rows, bool)
            for step in range(1, batch.num_rows):
                a = np.flatnonzero(block[step:] == block[:-step])
                if not len(a):
                    break
                b = a + step
                good = (100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b])) & _meeting(role, names, a, b)
                a, b = a[good], b[good]
                # The last bytes of minima agree wherever whole ones do.
                good = _agreeing(low[a], low[b]) >= LIKELY * HASHES
                a, b = a[good], b[good]
                if not len(a):
                    continue
                good = (sigs[a] == sigs[b]).sum(axis=1) >= LIKELY * HASHES
                # A pair belongs to the first order where both share a region.
                shared = (sigs[a][:, lead] == sigs[b][:, lead]).reshape(len(a), TREES, DEPTH).all(axis=2)
                good &= shared.argmax(axis=1) == tree[a]
                found[a[good]] = found[b[good]] = True
            at = np.flatnonzero(found)
            if len(at):
                yield batch.select(_PLACED.replace(" bigint", "").replace(" int", "").split(", ")).take(at)

    return find


def _joining(percent: int):
    """Links between the full sets of a block that join its components, a tree of them."""
    import pyarrow as pa

    def join(stream):
        import zstandard

        open_ = zstandard.ZstdDecompressor()
        for batch, block in _whole_blocks(stream):
            names = np.stack([batch.column(c).to_numpy() for c in ("d", "k", "ld", "lk")])
            role, z = batch.column("role").to_numpy(), batch.column("z")
            ends = np.append(np.flatnonzero(np.diff(block)) + 1, batch.num_rows).tolist()
            links = []
            for start, end in zip([0, *ends], ends):
                for x, y in _tree(names[:, start:end], role[start:end], [open_.decompress(v).decode() for v in z.slice(start, end - start).to_pylist()], percent):
                    links.append((start + x, start + y))
            if links:
                x, y = np.array(links).T
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (names[0, x], names[1, x], names[0, y], names[1, y])], names=["xd", "xk", "yd", "yk"])

    return join


def _tree(names: np.ndarray, role: np.ndarray, texts: list[str], percent: int) -> list[tuple[int, int]]:
    """Of one block: pairs of rows whose sets overlap by ``percent`` of their union, as many as join components."""
    found, own = _sets(texts)
    runs, code = np.unique(found, return_inverse=True)
    size = np.bincount(own, minlength=len(texts))
    starts = np.cumsum(size) - size
    _, label = np.unique(names[2:], axis=1, return_inverse=True)
    label = label.reshape(-1)  # components of this block; two become one when a link is found
    links, marked, every = [], np.zeros(len(runs), bool), np.arange(len(texts))
    for x in np.flatnonzero((role == _OUT) | (role == _ALONE)):
        mine = code[starts[x] : starts[x] + size[x]]
        marked[mine] = True
        both = np.bincount(own[marked[code]], minlength=len(texts))
        marked[mine] = False
        good = 100 * both >= percent * (size + size[x] - both)
        for y in np.flatnonzero(good & _meeting(role, names, np.full(len(texts), x), every)):
            if label[x] != label[y]:
                label[label == label[y]] = label[x]
                links.append((int(x), int(y)))
    return links


def _agreeing(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """In how many of the ``HASHES`` bytes each row agrees with this one; eight are compared and added up at a time."""
    eights = (rows == one).view("uint64").sum(axis=1)
    return (eights * np.uint64(0x0101010101010101)) >> np.uint64(56)


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links; they join whole components."""
    ends = links.select(F.col("x").alias("node")).unionByName(links.select(F.col("y").alias("node"))).distinct()
    known = labels.select("node", "label")
    base = materialize(known.unionByName(ends.join(known, "node", "left_anti").select("node", F.col("node").alias("label"))), "labels")
    own = base.select(F.col("node").alias("n"), F.col("label").alias("l"))
    up = links.join(own.withColumnsRenamed({"n": "x", "l": "lx"}), "x").join(own.withColumnsRenamed({"n": "y", "l": "ly"}), "y")
    top = components(up.select(F.col("lx").alias("x"), F.col("ly").alias("y")))
    joined = base.join(top.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left")
    out = materialize(joined.select("node", F.coalesce("top", "label").alias("label")), "labels")
    discard(labels, base, top)
    return out


def assign(narrow: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, _k, n, node (the document's class) and label (the smallest class of its component), a row per document."""
    signed = materialize(signatures(narrow), "signatures")
    classes = materialize(_classes(signed), "classes")
    neighbours = materialize(_neighbours(classes), "neighbours")
    members = neighbours.where("yd IS NULL").select("p", F.struct(F.col("xd").alias("d"), F.col("xk").alias("k")).alias("node"))
    texts = materialize(_packed_texts(narrow, members.select("node").distinct()), "class-texts")
    tried = materialize(_first_pairs(neighbours), "first-pairs")
    links = materialize(_links(tried, texts, percent), "links")
    labels = components(links)
    more = _rest_pairs(members, labels, classes, texts, percent)
    if not more.isEmpty():
        labels = _merged(labels, more)
    discard(tried, texts, neighbours, links, more)
    final = classes.select("n", "s1", "s2", "node").join(labels, "node", "left")
    final = final.select(F.col("n").alias("_n"), F.col("s1").alias("_s1"), F.col("s2").alias("_s2"), "node", F.coalesce("label", "node").alias("label"))
    final = materialize(final, "class-labels")
    discard(classes, labels)
    same = (F.col("n") == F.col("_n")) & (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2"))
    return signed.select("doc_id", "_k", "n", "s1", "s2").join(final, same, "left").select("doc_id", "_k", "n", "node", "label")


def _narrow(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return ground(docs, doc_id=F.col(id_column).cast("bigint"), text=F.col(text_column), _k=row_key(F.coalesce(F.col(text_column), F.lit(""))))


def near_duplicates(docs: DataFrame, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    own = assign(_narrow(docs, id_column, text_column), percent)
    top = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.nullif(F.col("label.d"), F.lit(_LAST)))
    told = own.select("doc_id", F.col("n").alias("n_shingles"), top.alias("component_id"))
    return told.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, percent: int = 75, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of each component, all its columns; of equal rows one; documents without words all stay."""
    own = assign(_narrow(docs, id_column, text_column), percent)
    first = own.where(F.col("n") > 0).where(_name("doc_id", "_k") == F.col("label"))
    taken = {c.lower() for c in docs.columns}

    def free(name: str) -> str:  # a column name that the input does not have
        while name.lower() in taken:
            name += "_"
        return name

    row_id, row_text, own_id, own_text = map(free, ("_row_id_", "_row_text_", "_own_id", "_own_text"))
    first = first.select(F.col("doc_id").alias(own_id), F.col("_k").alias(own_text))
    key = docs.select("*", docs[id_column].cast("bigint").alias(row_id), row_key(F.coalesce(docs[text_column], F.lit(""))).alias(row_text))
    wordless = F.coalesce(~docs[text_column].rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    kept = key.where(~wordless).join(
        first.distinct(), F.col(row_id).eqNullSafe(F.col(own_id)) & (F.col(row_text) == F.col(own_text)), "left_semi"
    ).dropDuplicates([row_id, row_text])
    return kept.unionByName(key.where(wordless)).drop(row_id, row_text)
