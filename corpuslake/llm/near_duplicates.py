"""Near-duplicate texts: MinHash bands, Bayesian pruning, exact verification.

Texts that are the same words form a class, of which one text is searched.
Candidates come from MinHash bands. Their sketches are compared a few values
at a time, and a pair is dropped as soon as the posterior probability that it
reaches the threshold falls below a tolerance. What is left is verified
exactly on the word shingles.
"""

from __future__ import annotations

from functools import lru_cache, partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import write_shared
from .sample import slices

#: Bands and rows: at similarity 0.6, 1 - (1 - 0.6**5)**90 = 999.3 of 1000
#: pairs share a band, at 0.65 all but two of 100,000.
BANDS, ROWS = 90, 5
#: Values of the sketch that pruning compares, how many at a time, and the
#: posterior probability below which a pair is dropped; over all eight steps
#: that loses 1 of 10,000 pairs at the threshold.
SKETCH, STEP, TOLERANCE = 128, 16, 0.00002
#: A verification group is split until it has about so many pairs at most, and
#: so no more than twice as many texts.
GROUP = 3_200

_U = np.uint64
_LETTERS = bytes(range(97, 123)) + bytes(range(48, 58))
_TABLE = bytes(
    b if b in _LETTERS else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)  # letters lower-cased, all that is no letter or digit a space


def _mix(x: np.ndarray) -> np.ndarray:
    """A public 64-bit finaliser: every bit of x reaches every bit."""
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


class _Words(dict):
    """word -> 64-bit value, the same on every worker; emptied when large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 7)
        return value


_WORDS = _Words()


def word_values(text: str) -> list[int]:
    """Values of the words (runs of a-z and 0-9 in the lower-cased text)."""
    data = (text if text.isascii() else text.lower()).encode("utf-8", "replace").translate(_TABLE)
    return list(map(_WORDS.__getitem__, data.split()))


def shingles(values: np.ndarray, k: int) -> np.ndarray:
    """Value of each run of k words."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = values[:n].copy()
    for i in range(1, k):
        out = _mix(out) + values[i : i + n]
    return _mix(out)


@lru_cache(4)
def _parameters(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_24)
    return rng.integers(0, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, count, dtype=np.uint32)


def minhashes(values: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """count x documents least values; a document's shingles begin at starts.

    Documents are taken in stretches that fit the processor's cache.
    """
    low = (values >> _U(32)).astype(np.uint32)
    a, b = _parameters(count)
    out = np.empty((count, len(starts)), np.uint32)
    ends = np.append(starts[1:], len(low))
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + 60_000)))
        part, cut = low[starts[at] : ends[to - 1]], starts[at:to] - starts[at]
        room = np.empty_like(part)
        for i in range(count):
            np.multiply(part, a[i], out=room)
            room += b[i]
            out[i, at:to] = np.minimum.reduceat(room, cut)
        at = to
    return out


def _signatures(batches, text: str, k: int, least_words: int, parts: list[str]):
    for batch in slices(batches):
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        values = [word_values(t) if t else [] for t in texts]
        keep = [i for i, v in enumerate(values) if len(v) >= max(least_words, k)]
        if not keep:
            continue
        sets = [shingles(np.array(values[i], _U), k) for i in keep]
        starts = np.cumsum([0, *map(len, sets)])[:-1]
        flat = np.concatenate(sets)
        least = minhashes(flat, starts, BANDS * ROWS + SKETCH)
        with np.errstate(over="ignore"):
            # The same words in the same order: two independent 64-bit values.
            weight = _mix(np.arange(1, int(np.diff(np.append(starts, len(flat))).max()) + 1, dtype=_U))
            same = [(int((s * weight[: len(s)]).sum(dtype=_U)), int((_mix(s) * weight[: len(s)]).sum(dtype=_U))) for s in sets]
            bands = np.zeros((len(keep), BANDS), _U)
            for j in range(BANDS):
                key = np.full(len(keep), j + 1, _U)
                for r in range(ROWS):
                    key = _mix(key) + least[j * ROWS + r]
                bands[:, j] = _mix(key)
        sketch = np.ascontiguousarray((least[BANDS * ROWS :] >> 16).astype(np.uint16).T)
        rows = batch.take(pa.array(keep))
        rest = [rows.column(rows.schema.get_field_index(p)) for p in parts]
        band_col = pa.ListArray.from_arrays(
            pa.array(np.arange(len(keep) + 1, dtype=np.int32) * BANDS), pa.array(bands.reshape(-1).view(np.int64))
        )
        yield pa.RecordBatch.from_arrays(
            [
                *rest,
                pa.array([f"{x:016x}{y:016x}" for x, y in same]),
                band_col,
                pa.array([s.tobytes() for s in sketch], pa.binary()),
            ],
            names=[*parts, "same", "bands", "sketch"],
        )


@lru_cache(8)
def least_matches(threshold: float, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For 16, 32, ... compared values: the fewest equal ones with which the
    similarity may still reach the threshold. With a uniform prior the
    posterior is a Beta law, and P(S >= t | m of n) is the chance that of
    n + 1 draws with probability t at most m succeed."""
    out = []
    for n in range(STEP, SKETCH + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def _prune(batches, threshold: float):
    need = least_matches(threshold)
    for b in batches:
        left, right = (
            np.frombuffer(b"".join(b.column(b.schema.get_field_index(c)).to_pylist()), np.uint16).reshape(b.num_rows, SKETCH)
            for c in ("sketch_a", "sketch_b")
        )
        alive, equal = np.arange(b.num_rows), np.zeros(b.num_rows, np.int64)
        for i, m in enumerate(need):
            part = slice(i * STEP, (i + 1) * STEP)
            equal[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
            alive = alive[equal[alive] >= m]
        yield b.select(["a", "b"]).take(pa.array(alive))


def _verify(key, left: pa.Table, right: pa.Table, text: str, k: int, threshold: float) -> pa.Table:
    """One group: documents (left) and the pairs among them (right)."""
    sets = {
        i: np.unique(shingles(np.array(word_values(t), _U), k))
        for i, t in zip(left.column("id").to_pylist(), left.column(text).to_pylist())
    }
    a, b, out = right.column("a").to_pylist(), right.column("b").to_pylist(), []
    for x, y in zip(a, b):
        p, q = sets[x], sets[y]
        if min(len(p), len(q)) < threshold * max(len(p), len(q)):
            continue
        if len(p) > len(q):
            p, q = q, p
        at = np.searchsorted(q, p)
        at[at == len(q)] = 0
        common = int((q[at] == p).sum())
        union = len(p) + len(q) - common
        if common >= threshold * union - 1e-9:
            out.append((x, y, common / union))
    xs, ys, s = zip(*out) if out else ((), (), ())
    return pa.table({"a": pa.array(xs, pa.int64()), "b": pa.array(ys, pa.int64()), "similarity": pa.array(s, pa.float64())})


def near_duplicates(
    docs: DataFrame, key: str, text: str, group: str | None = None, k: int = 5, threshold: float = 0.8, least_words: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(pairs, members) of texts whose shingle similarity reaches threshold.

    members: group, key, cls - each text of at least least_words (and k) words
    with the id of its class: texts that are the same words in the same order.
    pairs: a, b, similarity of classes, a < b; only within one group. The
    similarity is the share of distinct k-word shingles that both have among
    all that either has. Null keys and null or short texts are in no class;
    rows that repeat a key must repeat its text and count once; an empty table
    gives empty results. Other columns are ignored.
    """
    parts = ["grp", "key"]
    src = docs.where(F.col(key).isNotNull()).select(
        (F.col(group) if group else F.lit("")).alias("grp"), F.col(key).alias("key"), F.col(text).alias("text")
    )
    schema = T.StructType([
        T.StructField("grp", T.StringType()), T.StructField("key", src.schema["key"].dataType), T.StructField("same", T.StringType()),
        T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType()),
    ])
    run = partial(_signatures, text="text", k=k, least_words=least_words, parts=parts)
    signed = write_shared(src.mapInArrow(run, schema).withColumn("id", F.monotonically_increasing_id()), "nd-signed")

    # One text of each class goes on; the others are only members.
    members = write_shared(
        signed.select("grp", "key", "id", "same").join(signed.groupBy("grp", "same").agg(F.min("id").alias("cls")), ["grp", "same"]).drop("same"),
        "nd-members",
    )
    reps = signed.join(members.where("id = cls").select("id"), "id", "left_semi")
    band = reps.select("id", F.explode("bands").alias("band"), F.xxhash64("grp").alias("g")).select("id", F.expr("band ^ g").alias("band"))
    # A hot band is a skewed join partition, which the engine splits; its rows
    # stream through and are never gathered.
    pairs = (
        band.select(F.col("id").alias("a"), "band")
        .join(band.select(F.col("id").alias("b"), "band"), "band")
        .where("a < b")
        .select("a", "b")
        .distinct()
    )
    sketches = reps.select("id", "sketch")
    pairs = pairs.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sketch_a")), "a")
    pairs = pairs.join(sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sketch_b")), "b")
    pairs = write_shared(pairs.mapInArrow(partial(_prune, threshold=threshold), "a long, b long"), "nd-pairs")

    # Verification: pairs meet in the group of their least neighbour, so that a
    # text is sent and cut into shingles once for a whole cluster of copies.
    ends = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"), F.count("*").alias("links"))
    low = near.select(F.col("a").alias("n"), "low")
    placed = pairs.join(low.select(F.col("n").alias("a"), F.col("low").alias("la")), "a").join(
        low.select(F.col("n").alias("b"), F.col("low").alias("lb")), "b"
    )
    placed = placed.withColumn("hub", F.least("la", "lb"))
    # A hub with many texts is split into blocks of texts; a pair lies in the
    # cell of its two blocks, a text goes to the cells in which it has pairs.
    # Where one text has most of the pairs (a star), blocks alone leave cells
    # too large; those are split by pair.
    many = placed.groupBy("hub").agg(F.greatest(F.lit(1).cast("long"), F.ceil(F.count("*") / GROUP)).alias("blocks"))
    cut = lambda c: F.pmod(F.xxhash64(c), F.ceil(F.sqrt("blocks")).cast("long"))
    placed = placed.join(many, "hub").withColumn("x", cut("a")).withColumn("y", cut("b")).select("a", "b", "hub", "x", "y")
    full = placed.groupBy("hub", "x", "y").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    placed = placed.join(full, ["hub", "x", "y"]).withColumn("z", F.pmod(F.xxhash64("a", "b"), F.col("parts")))
    placed = write_shared(placed.select("a", "b", "hub", "x", "y", "z"), "nd-placed")
    cell = ["hub", "x", "y", "z"]
    needs = placed.select(*cell, F.col("a").alias("id")).unionByName(placed.select(*cell, F.col("b").alias("id"))).distinct()
    who = members.where("id = cls").select("grp", "key", "id")
    needs = needs.join(who, "id")
    texts = src.join(needs, ["grp", "key"]).select(*cell, "id", "text")
    verified = (
        texts.groupBy(*cell)
        .cogroup(placed.select("a", "b", *(F.col(c).alias(c + "_") for c in cell)).groupBy(*(c + "_" for c in cell)))
        .applyInArrow(partial(_verify, text="text", k=k, threshold=threshold), "a long, b long, similarity double")
    )
    return write_shared(verified, "nd-verified"), members


def expand(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """grp, key_a, key_b of all pairs of rows: those of linked classes and
    those within a class; key_a < key_b."""
    m = members.select("grp", "key", "cls")
    across = (
        pairs.join(m.select(F.col("cls").alias("a"), F.col("key").alias("ka"), "grp"), "a")
        .join(m.select(F.col("cls").alias("b"), F.col("key").alias("kb")), "b")
        .select("grp", "ka", "kb")
    )
    within = m.select("grp", "cls", F.col("key").alias("ka")).join(m.select("cls", F.col("key").alias("kb")), "cls").where("ka < kb").select("grp", "ka", "kb")
    return (
        across.unionByName(within)
        .where("ka <> kb")
        .select("grp", F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b"))
        .distinct()
    )
