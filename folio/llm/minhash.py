"""Near-duplicate groups: many universal hash minima, banding, verification, alternating stars.

1. Each text's shingles (whole text) give ``HASHES`` minima of universal hashes and a fingerprint
   of the set. Texts with equal sets are one class from here on, whatever their number.
2. Classes that agree in all minima of a band share a bucket. Each class is compared, by signature
   and then by full set, with the least member of its buckets that it shares most buckets with.
3. Stars give components. A bucket whose members are in one component holds no more links that
   matter. In the others, members of different components are compared with each other, in
   blocks of bounded size: by signature, then by full set, until what a block's links have
   joined needs no more comparing. Stars of all links give the groups.

No pair is left out that shares a bucket and lies in different components, nor are all pairs of
a group of copies ever made: within a component nothing is compared any more. At similarity 0.8,
48 bands of 5 minima miss a pair with probability 5e-9; the signature check, which rejects pairs
with under 148 of 240 equal minima, another with 2e-11.

Defined cases: a text of fewer words than a shingle has its whole sequence as its one shingle; null,
empty and blank texts have no shingles and are linked with nothing; rows that repeat an id
are grouped each by its own text, a group's id being the least in it (so unlike groups whose least
id is the same one share a component_id, and ``keep_one`` keeps a row of each of them); rows with
the same id and the same shingles are repeats; a null id has no component and is kept; no rows give
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.components import components
from folio.llm.shared import small_side, stage
from folio.llm.textnum import chunks, mix, shingle_set, word_bounds, word_hashes

U = np.uint64
HASHES, BANDS = 240, 48
_GEN = np.random.Generator(np.random.PCG64(8191))
_A = _GEN.integers(0, 1 << 63, HASHES, dtype=np.uint64) * U(2) + U(1)
_B = _GEN.integers(0, 1 << 63, HASHES, dtype=np.uint64) * U(2)
DEVIATIONS = 7.0        # a pair at the threshold may have so many standard deviations fewer equal minima
BLOCK = 512             # members of a bucket that are compared as one block, by signature
BLOCK_SHINGLES = 1 << 17  # shingles of such a block, by full set
ID_LIST = 2_000_000     # ids that may be broadcast (16 MB); longer lists are joined by a shuffle
SIGNATURES = "doc_id long, n_shingles long, set_a long, set_b long, signature binary"


# ---- signatures -----------------------------------------------------------------------------

def shingles_of(col: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text."""
    for lo, hi, buf, offs in chunks(col):
        starts, ends, first = word_bounds(buf, offs)
        h = word_hashes(buf, starts, ends) if len(starts) else np.empty(0, U)
        for i in range(hi - lo):
            yield shingle_set(h[first[i]:first[i + 1]], k)


def signature(s: np.ndarray) -> np.ndarray:
    """The least value of each universal hash over the set, 16 of its bits."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, U)
    for lo in range(0, len(s), 1024):
        v = s[None, lo:lo + 1024] * _A[:, None]
        v += _B[:, None]
        np.minimum(least, v.min(axis=1), out=least)
    return (least >> U(24)).astype(np.uint16)


def fingerprint(s: np.ndarray) -> tuple[int, int, int]:
    """n_shingles, set_a and set_b of a set."""
    if not len(s):
        return 0, 0, 0
    return len(s), int(mix(s).sum(dtype=U).view(np.int64)), int(np.bitwise_xor.reduce(mix(s ^ U(0x5851F42D4C957F2D))).view(np.int64))


def _fingerprint_task(k: int):
    """The first column, and the fingerprint of the text in the second."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(s) for s in shingles_of(batch.column(1), k)], np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, i]) for i in range(3))], names=[batch.schema.names[0], "_n", "_a", "_b"])

    return run


def _signature_task(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, sig = [], [], [], []
            for s in shingles_of(batch.column(1), k):
                for x, to in zip(fingerprint(s), (n, a, b)):
                    to.append(x)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sig, pa.binary())],
                                             names=["doc_id", "n_shingles", "set_a", "set_b", "signature"])

    return run


def _signatures(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(-1, HASHES)


def _band_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = HASHES // BANDS
    for batch in batches:
        for lo in range(0, batch.num_rows, 2000):
            part = batch.slice(lo, 2000)
            sig = _signatures(part.column(1)).reshape(-1, BANDS, rows).astype(U)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U), sig.shape[:2]) * U(0x9E3779B97F4A7C15)
            for i in range(rows):
                key = mix(key ^ (sig[:, :, i] + U((i + 1) << 40)))
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), part.num_rows)),
                                              pa.array(np.repeat(part.column(0).to_numpy(), BANDS))], names=["bucket", "band", "rep"])


# ---- comparing pairs ------------------------------------------------------------------------

def _only(table: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ``column`` is among the (staged, distinct) ids; only a list of checked size is broadcast."""
    return table.join(small_side(ids.select(F.col("id").alias(column)), ID_LIST), column, "left_semi")


def _ids(pairs: DataFrame) -> DataFrame:
    return stage(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "near-ids")


def _sizes_fit(n: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of such sizes can reach the threshold."""
    return 100 * np.minimum(n, other) >= percent * np.maximum(n, other)


def _alike(pairs: DataFrame, classes: DataFrame, least_equal: int, percent: int) -> DataFrame:
    """The staged pairs whose signatures agree often enough and whose sizes allow the threshold."""
    side = stage(_only(classes, "rep", _ids(pairs)), "near-compared")
    a = side.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("sig_a"))
    b = side.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("sig_b"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                equal = (_signatures(batch.column(4)) == _signatures(batch.column(5))).sum(axis=1)
                fit = _sizes_fit(batch.column(2).to_numpy(), batch.column(3).to_numpy(), percent)
                yield batch.select(["a", "b"]).filter(pa.array((equal >= least_equal) & fit))

    return joined.mapInArrow(run, "a long, b long")


def _set_task(k: int):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in shingles_of(batch.column(1), k)], pa.binary())], names=["id", "shingles"])

    return run


def _named_set_task(k: int):
    def run(batches):
        for batch in batches:
            ids, sets = batch.column(0), [(fingerprint(s), s.tobytes()) for s in shingles_of(batch.column(1), k)]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([f[i] for f, _ in sets], pa.int64()) for i in range(3)), pa.array([s for _, s in sets], pa.binary())],
                                             names=["_id", "_n", "_a", "_b", "shingles"])

    return run


def _sets(reps: DataFrame, classes: DataFrame, texts: DataFrame, k: int, shared: bool) -> DataFrame:
    """(id, shingles) of the classes whose reps are among the staged ids. Only their texts are read."""
    if not shared:
        return stage(_only(texts, "id", reps).mapInArrow(_set_task(k), "id long, shingles binary"), "near-sets")
    wanted = stage(_only(classes, "rep", reps).select("rep", "least", "set_a", "set_b", "n_shingles"), "near-wanted")
    ids = stage(wanted.select(F.col("least").alias("id")).distinct(), "near-ids")
    read = _only(texts, "id", ids).mapInArrow(_named_set_task(k), "_id long, _n long, _a long, _b long, shingles binary")
    found = read.join(small_side(wanted, ID_LIST // 5), F.expr("_id = least AND _a = set_a AND _b = set_b AND _n = n_shingles"))
    sets = stage(found.select(F.col("rep").alias("id"), "shingles"), "near-sets")
    return sets if sets.groupBy("id").count().where("count > 1").isEmpty() else stage(sets.dropDuplicates(["id"]), "near-sets")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if not len(x) or not len(y):
        return False
    common = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _verify_task(percent: int):
    def run(batches):
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                good[i] = _linked(*(np.frombuffer(batch.column(c)[i].as_buffer(), U) for c in (2, 3)), percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, k: int, percent: int, shared: bool) -> DataFrame:
    """The staged pairs whose full sets reach the threshold. Only texts in a pair are read."""
    sets = _sets(_ids(pairs), classes, texts, k, shared)
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
    rows = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b")
    return stage(rows.mapInArrow(_verify_task(percent), "a long, b long"), "near-links")


# ---- buckets whose members are in several components ------------------------------------------

def _open_members(members: DataFrame, comps: DataFrame) -> DataFrame:
    """(bucket, band, rep, comp) of the buckets that hold more than one component."""
    named = members.join(comps, members.rep == comps.node, "left").select("bucket", "band", "rep", F.coalesce("component", "rep").alias("comp"))
    split = named.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where(F.col("lo") != F.col("hi")).select(F.col("bucket").alias("open"))
    return named.join(split, F.col("bucket") == F.col("open"), "left_semi")


def _fields(rows) -> tuple:
    """Columns of a block: reps, components, sizes, signatures, and what else there is."""
    v = rows.values
    return (*(v.field(i).to_numpy() for i in range(3)), _signatures(v.field(3)), *(v.field(i) for i in range(4, v.type.num_fields)))


def _candidates(j: int, x: tuple, y: tuple, band: int, main: int, least_equal: int, percent: int) -> np.ndarray:
    """Members of block y that stray j of block x has to be compared with, likeliest first.

    A pair comes up only in the first band that it shares, and two strays only once.
    """
    reps_x, comps_x, n_x, sig_x = x[:4]
    reps_y, comps_y, n_y, sig_y = y[:4]
    other = np.flatnonzero((comps_y != comps_x[j]) & ((comps_y == main) | (reps_y > reps_x[j])) & _sizes_fit(n_y, n_x[j], percent))
    same = sig_y[other] == sig_x[j]
    equal = same.sum(axis=1)
    good = np.flatnonzero(equal >= least_equal)
    shared = same[good].reshape(len(good), BANDS, HASHES // BANDS).all(axis=2)
    good = good[shared.argmax(axis=1) == band]
    return other[good[np.lexsort((reps_y[other[good]], -equal[good]))]]


def _alike_task(least_equal: int, percent: int):
    """(bucket, rep) of members that have somebody to be compared with."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                bucket, band, main = (batch.column(c)[i].as_py() for c in range(3))
                x, y = _fields(batch.column(3)[i]), _fields(batch.column(4)[i])
                found_x, found_y = np.zeros(len(x[0]), bool), np.zeros(len(y[0]), bool)
                for j in range(len(x[0])):
                    other = _candidates(j, x, y, band, main, least_equal, percent)
                    found_x[j], found_y[other] = len(other) > 0, True
                reps = np.union1d(x[0][found_x], y[0][found_y])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(reps), bucket, np.int64)), pa.array(reps)], names=["bucket", "rep"])

    return run


def _link_task(least_equal: int, percent: int):
    """Links (a, b) between the components of two blocks, found on full sets. What links have joined
    within the two blocks is not compared again, so there are fewer links than members."""
    def run(batches):
        for batch in batches:
            out: list[tuple[int, int]] = []
            for i in range(batch.num_rows):
                band, main = (batch.column(c)[i].as_py() for c in (1, 2))
                x, y = _fields(batch.column(3)[i]), _fields(batch.column(4)[i])
                joined: dict[int, int] = {}

                def root(c: int) -> int:
                    while c in joined:
                        c = joined[c]
                    return c

                for j in range(len(x[0])):
                    own = np.frombuffer(x[4][j].as_buffer(), U)
                    for k in _candidates(j, x, y, band, main, least_equal, percent).tolist():
                        c, d = root(int(x[1][j])), root(int(y[1][k]))
                        if c != d and _linked(own, np.frombuffer(y[4][k].as_buffer(), U), percent):
                            joined[max(c, d)] = min(c, d)
                            out.append((int(x[0][j]), int(y[0][k])))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())], names=["a", "b"])

    return run


def _meet(open_: DataFrame, content: DataFrame, limit: int, task, schema: str) -> DataFrame:
    """Let the members of each open bucket that lie in different components meet, block by block.

    All but a bucket's largest component are strays: blocks of strays meet blocks of all members, so
    that what is compared grows with a bucket's size times its strays. ``content`` has rep, weight and
    what a comparison needs; a block's weights come to about ``limit``.
    """
    known = open_.join(content, "rep")
    sizes = known.groupBy("bucket", "comp").agg(F.sum("weight").alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("m"), F.sum("n").alias("all"))
    plan = sizes.select(F.col("bucket").alias("p_bucket"), F.col("m.comp").alias("main"), F.ceil(F.col("all") / limit).alias("blocks"),
                        F.greatest(F.lit(1), F.ceil((F.col("all") - F.col("m.n")) / limit)).alias("stray_blocks"))
    spread = F.xxhash64("rep")
    everyone = F.struct(F.lit(False).alias("stray"), F.pmod(spread, F.col("blocks")).alias("block"))
    strays = F.struct(F.lit(True).alias("stray"), F.pmod(spread, F.col("stray_blocks")).alias("block"))
    fields = [c for c in content.columns if c not in ("rep", "weight")]
    placed = known.join(plan, F.col("bucket") == F.col("p_bucket")).select(
        "bucket", "band", "main", "rep", "comp", *fields, F.explode(F.when(F.col("comp") == F.col("main"), F.array(everyone)).otherwise(F.array(everyone, strays))).alias("at"))
    blocks = stage(placed.groupBy("bucket", "band", "main", F.col("at.stray").alias("stray"), F.col("at.block").alias("block")).agg(
        F.collect_list(F.struct("rep", "comp", *fields)).alias("rows")), "near-blocks")
    x = blocks.where("stray").select("bucket", "band", "main", F.col("rows").alias("x"))
    y = blocks.where("NOT stray").select("bucket", F.col("rows").alias("y"))
    return x.join(y, "bucket").select("bucket", "band", "main", "x", "y").mapInArrow(task, schema)


def _links_across(open_: DataFrame, classes: DataFrame, texts: DataFrame, k: int, least_equal: int, percent: int, shared: bool) -> DataFrame:
    """The links between components that share a bucket: signatures tell who has to be compared, full
    sets of those decide."""
    reps = stage(open_.select(F.col("rep").alias("id")).distinct(), "near-ids")
    signed = stage(_only(classes, "rep", reps).select("rep", F.lit(1).alias("weight"), "n_shingles", "signature"), "near-compared")
    alike = stage(_meet(open_, signed, BLOCK, _alike_task(least_equal, percent), "bucket long, rep long").distinct(), "near-alike")
    ids = stage(alike.select(F.col("rep").alias("id")).distinct(), "near-ids")
    sets = _sets(ids, classes, texts, k, shared)
    full = signed.join(sets, F.col("rep") == F.col("id")).select("rep", F.col("n_shingles").alias("weight"), "n_shingles", "signature", "shingles")
    return stage(_meet(open_.join(alike, ["bucket", "rep"], "left_semi"), full, BLOCK_SHINGLES, _link_task(least_equal, percent), "a long, b long"), "near-links")


# ---- the operator -----------------------------------------------------------------------------

def _groups(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> tuple[DataFrame, bool]:
    """(doc_id, n_shingles, set_a, set_b, part, component_id) of every document, and whether some id has
    texts of several sets. ``part`` tells groups apart; it is null for texts without shingles.

    A class is named by the least id that has its text; by a number of its own where ids are shared.
    """
    share = percent / 100
    least_equal = max(1, int(HASHES * share - DEVIATIONS * (HASHES * share * (1 - share)) ** 0.5))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = stage(texts.mapInArrow(_signature_task(shingle), SIGNATURES), "near-signatures")
    sets_of = signed.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("n_shingles", "set_a", "set_b")])
    shared = not sets_of.where("min_n_shingles != max_n_shingles OR min_set_a != max_set_a OR min_set_b != max_set_b").isEmpty()
    worded = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = stage(worded.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("least"), F.min("signature").alias("signature")).withColumn(
        "rep", F.monotonically_increasing_id() if shared else F.col("least")), "near-reps")
    of = classes.select(F.col("set_a").alias("f_a"), F.col("set_b").alias("f_b"), F.col("n_shingles").alias("f_n"), "rep", "least")
    named = signed.select("doc_id", "n_shingles", "set_a", "set_b").join(
        of, F.expr("doc_id IS NOT NULL AND set_a = f_a AND set_b = f_b AND n_shingles = f_n"), "left")
    member_of = stage(named.select("doc_id", "n_shingles", "set_a", "set_b", "rep", "least"), "near-classes")

    banded = classes.select("rep", "signature").mapInArrow(_band_task, "bucket long, band int, rep long")
    hubs = banded.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where(F.col("hub") != F.col("last")).select(F.col("bucket").alias("h_bucket"), "hub")
    members = stage(banded.join(hubs, F.col("bucket") == F.col("h_bucket")).select("bucket", "band", "rep", "hub"), "near-buckets")

    several = members.where(F.col("rep") != F.col("hub")).groupBy("hub", "rep").agg(F.count(F.lit(1)).alias("n"))
    nearest = several.groupBy("rep").agg(F.min_by("hub", F.struct(-F.col("n"), F.col("hub"))).alias("a"))
    tested = stage(nearest.select("a", F.col("rep").alias("b")), "near-tested")
    links = _confirmed(stage(_alike(tested, classes, least_equal, percent), "near-alike"), classes, texts, shingle, percent, shared)
    comps = components(links)
    open_ = stage(_open_members(members, comps), "near-open")
    if not open_.isEmpty():
        comps = components(links.union(_links_across(open_, classes, texts, shingle, least_equal, percent, shared)))
    found = stage(comps, "near-components")
    out = member_of.join(found, F.col("rep") == F.col("node"), "left").withColumn("part", F.coalesce("component", "rep"))
    if not shared:
        return out.select("doc_id", "n_shingles", "set_a", "set_b", "part", F.coalesce("part", "doc_id").alias("component_id")), shared
    linked = found.join(classes.select("rep", "least"), F.col("node") == F.col("rep"))
    first = stage(linked.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("first")), "near-first")
    return out.join(small_side(first, ID_LIST), F.col("component") == F.col("of"), "left").select(
        "doc_id", "n_shingles", "set_a", "set_b", "part", F.coalesce("first", "least", "doc_id").alias("component_id")), shared


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document: the least id that links reach, and whether it is
    the document's own. Linked: 100 * common shingles >= percent * all shingles of two texts."""
    found, _ = _groups(docs, id_col, text_col, shingle, percent)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns; the others go."""
    groups, shared = _groups(docs, id_col, text_col, shingle, percent)
    found = stage(groups.where(F.col("doc_id").isNotNull()), "near-verdicts")
    if shared:
        return _keep_rows(docs, found, id_col, text_col, shingle)
    gone = stage(found.where("doc_id != component_id").select(F.col("doc_id").alias("_near_gone")).distinct(), "near-gone")
    kept = docs.join(small_side(gone, ID_LIST), F.col(id_col) == F.col("_near_gone"), "left_anti")
    repeated = found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1")
    return kept if repeated.isEmpty() else kept.where(F.col(id_col).isNull()).union(kept.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]))


def _keep_rows(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``keep_one`` where an id has unlike texts: rows are told apart by id and fingerprint, and the least of a group stays."""
    key = ("doc_id", "n_shingles", "set_a", "set_b")
    least = found.where(F.col("part").isNotNull()).groupBy("part").agg(F.min(F.struct(*key)).alias("stays"))
    stays = stage(least.select("stays.*"), "near-stays")
    gone = stage(found.where(F.col("part").isNotNull()).select(*key).distinct().join(stays, list(key), "left_anti"), "near-gone")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_col).cast("string").alias("_text"))
    schema = f"_row {rows.schema['_row'].dataType.simpleString()}, _n long, _a long, _b long"
    marked = stage(rows.mapInArrow(_fingerprint_task(shingle), schema).withColumn("_id", F.col("_row").getField(id_col).cast("long")), "near-rows")
    kept = marked.join(small_side(gone, ID_LIST // 5), F.expr("_id = doc_id AND _n = n_shingles AND _a = set_a AND _b = set_b"), "left_anti")
    if not found.groupBy(*key).count().where("count > 1").isEmpty():
        kept = kept.where("_id IS NULL").union(kept.where("_id IS NOT NULL").dropDuplicates(["_id", "_n", "_a", "_b"]))
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
