"""Sharding along a Hilbert curve through metadata space, for files that prune in every dimension.

Each row's metadata is quantised to a cell of a small cube: size by powers of two, text
columns by a hash bin. Cells are ordered by their index on the Hilbert curve, and the
ordered rows are cut into runs of equal row counts (law 'rows': counts at most one apart).
A shard is then a compact region, so min/max statistics per file prune on any dimension.

Equal texts are one group: a group whose rows differ in their text columns takes the cell of
its least (lang, source) bins, and within a cell rows are ordered by the text's checksum,
then id. So copies lie next to each other, and as law 'rows' comes first, only a group that
a cut falls into, or larger than a shard, lies in several (consecutive) shards.

DataFrame functions only, and no global sort. Rows are counted by (cell, 64 runs of the
checksum, 64 runs of those, and, for texts with over HOT_ROWS rows only, the text and a bin
of the id); the counts are summed up into offsets level by level, and each bin numbers its
own rows. A hot cell spreads over its runs, a hot text over ID_BINS bins.

Null text: size 1, checksum 0. Null metadata has a bin of its own kind (hash of ''). Within
a bin null ids are ordered first. Repeated rows take neighbouring slots; a text that is hot
by repeated rows of one id is one bin, which Spark spills. Other columns are ignored.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meetloom.llm.common import saved

BITS = 4
BINS = 1 << BITS
#: Runs of the checksum at each of two levels, bins of the id that a text of over HOT_ROWS rows is spread over, and mixed groups that are broadcast at most.
RUN_BITS, ID_BINS, HOT_ROWS, BROADCAST_GROUPS = 6, 256, 20_000, 200_000


def size_bin(size: Column) -> Column:
    """floor(log2(size)), the top bin open."""
    return F.least(F.lit(BINS - 1), F.length(F.bin(size)) - 1).cast("int")


def name_bin(name: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(name, F.lit("")).cast("binary")), 1, 1), 16, 10).cast("int")


def hilbert_index(cell: tuple[int, ...], bits: int = BITS) -> int:
    """Position on the Hilbert curve of a cell with coordinates in [0, 2**bits), by Skilling's transpose form: undo the
    reflections from the top bit down, make the axes a Gray code, then read their bits in turn."""
    x = list(cell)
    for b in reversed(range(1, bits)):
        low = (1 << b) - 1
        for i in range(len(x)):
            if x[i] >> b & 1:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0] ^= swap
                x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    fix = 0
    for b in range(1, bits):
        if x[-1] >> b & 1:
            fix ^= (1 << b) - 1
    index = 0
    for b in reversed(range(bits)):
        for v in x:
            index = index << 1 | (v ^ fix) >> b & 1
    return index


def curve_position(axes: list[Column], bits: int = BITS) -> Column:
    """The curve index of a cell from a literal table of all (1 << bits)**axes cells, built from the rule above."""
    size = 1 << bits
    table = [hilbert_index(cell, bits) for cell in product(range(size), repeat=len(axes))]
    code = F.lit(0)
    for a in axes:
        code = code * size + a
    return F.get(F.expr(f"array({', '.join(map(str, table))})"), code)


def _offsets(bins: DataFrame, key: list[str], by: list[str], name: str) -> DataFrame:
    """bins with `name`: the rows before each bin of those that agree in key, in the order of `by`."""
    before = Window.partitionBy(*key).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return bins.withColumn(name, F.coalesce(F.sum("n").over(before), F.lit(0)))


def hilbert_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, and the three bins with the curve index (for file statistics)."""
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_key"), name_bin(docs[names[0]]).alias("bin_a"), name_bin(docs[names[1]]).alias("bin_b"))
    rows = saved(rows)  # texts are read once
    both = F.struct("bin_a", "bin_b")
    groups = rows.groupBy("text_key").agg(F.min(both).alias("least"), F.max(both).alias("most"), F.count(F.lit(1)).alias("copies"))
    odd = saved(groups.where((F.col("least") != F.col("most")) | (F.col("copies") > HOT_ROWS)).select("text_key", F.col("least.bin_a").alias("group_a"), F.col("least.bin_b").alias("group_b"), (F.col("copies") > HOT_ROWS).alias("hot")))
    rows = rows.join(F.broadcast(odd) if odd.count() <= BROADCAST_GROUPS else odd, "text_key", "left")
    rows = rows.withColumns({"bin_a": F.coalesce("group_a", "bin_a"), "bin_b": F.coalesce("group_b", "bin_b"), "bin_size": size_bin(F.col("size"))}).drop("group_a", "group_b")
    rows = rows.withColumn("cell", curve_position([F.col("bin_a"), F.col("bin_b"), F.col("bin_size")]))
    run = lambda level: F.shiftright("text_crc32", 32 - level * RUN_BITS).bitwiseAND((1 << RUN_BITS) - 1).cast("int")
    hot = F.coalesce("hot", F.lit(False))
    id_bin = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % ID_BINS).cast("int")
    # In a run of the second level, texts that are not hot come first (own -1), then each hot one.
    rows = rows.withColumns({"run": run(1), "sub": run(2), "own": F.when(hot, F.col("text_crc32")).otherwise(F.lit(-1).cast("long")), "own_key": F.when(hot, F.col("text_key")).otherwise(F.lit(0).cast("long")), "id_bin": F.when(hot, id_bin).otherwise(F.lit(0))}).drop("hot", "text_key")
    bin_of = ["cell", "run", "sub", "own", "own_key", "id_bin"]
    bins = saved(rows.groupBy(*bin_of).agg(F.count(F.lit(1)).alias("n")))
    runs = bins.groupBy("cell", "run").agg(F.sum("n").alias("n"))  # at most BINS**3 << RUN_BITS rows
    cells = runs.groupBy("cell").agg(F.sum("n").alias("n"))  # at most BINS**3 rows
    cells = _offsets(cells, [], ["cell"], "cell_start").withColumn("total", F.sum("n").over(Window.partitionBy())).drop("n")
    runs = _offsets(runs, ["cell"], ["run"], "run_start").drop("n").join(F.broadcast(cells), "cell").select("cell", "run", (F.col("cell_start") + F.col("run_start")).alias("run_start"), "total")
    starts = _offsets(bins, ["cell", "run"], bin_of[2:], "bin_start").drop("n").join(F.broadcast(runs), ["cell", "run"]).select(*bin_of, (F.col("run_start") + F.col("bin_start")).alias("start"), "total")
    own = Window.partitionBy(*bin_of).orderBy("text_crc32", "doc_id", "size")
    numbered = rows.withColumn("nth", F.row_number().over(own)).join(starts, bin_of).withColumn("place", F.col("start") + F.col("nth") - 1)
    numbered = numbered.withColumn("shard", F.expr(f"(place * {shards}) div total").cast("int"))
    first = F.expr(f"(shard * total + {shards} - 1) div {shards}")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("place") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "bin_a", "bin_b", "bin_size", F.col("cell").alias("curve_index"))


def shard_manifest(sharded: DataFrame) -> DataFrame:
    """Per shard: rows, bytes and min/max of every bin; a reader skips shards whose ranges miss its predicate."""
    stats = [f(c).alias(f"{name}_{c}") for c in ("bin_a", "bin_b", "bin_size", "curve_index") for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *stats)

