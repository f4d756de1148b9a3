"""Orders per address in a rolling look-back, and the verdict built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwatch.functions.scalars import interval_seconds

IP, TIME, ORDER = "ip_address", "timestamp", "order_id"
MICROS = 1_000_000
SPLITS = 64


def _levels(moments: DataFrame, look_back: str, cells: int) -> DataFrame:
    """Orders of each address that lie in the look-back, at each of its order times: `level`, beside its own `n`.

    `moments` has the number of orders `n` per address and time. Each moment adds n at its time and
    takes n away one look-back later, when its orders are exactly too old; the level is the running
    sum. The sum is split into time cells, of which a look-back is a whole number: a cell opens with
    the orders of the `cells` cells before it. What a task sorts is then the different order times of
    one address in one cell, however many orders they stand for, and no frame is scanned twice.
    """
    length = interval_seconds(look_back)
    if not length or length * MICROS % cells:
        raise ValueError(f"no {cells} whole cells in a look-back of {look_back!r}")
    micros = length * MICROS
    cell = f"{micros // cells} microseconds"
    own = moments.withColumn("cell", F.window(TIME, cell)["start"])
    before = F.expr(
        f"sum(n) OVER (PARTITION BY {IP} ORDER BY cell RANGE BETWEEN"
        f" INTERVAL {micros} MICROSECONDS PRECEDING AND INTERVAL {cell} PRECEDING)"
    )
    openings = own.groupBy(IP, "cell").agg(F.sum("n").alias("n")).withColumn("n", before).filter("n IS NOT NULL")
    gone = F.expr(f"INTERVAL {micros} MICROSECONDS")
    coming = F.struct(F.col(TIME).alias("at"), F.col("n").alias("change"), F.col("cell"))
    going = F.struct((F.col(TIME) + gone).alias("at"), (-F.col("n")).alias("change"), (F.col("cell") + gone).alias("cell"))
    # An opening has no time and sorts first; an order time is a change that adds.
    changes = own.select(IP, F.inline(F.array(coming, going))).unionByName(
        openings.select(IP, F.lit(None).cast(own.schema[TIME].dataType).alias("at"), F.col("n").alias("change"), "cell")
    )
    upto = Window.partitionBy(IP, "cell").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    levels = changes.withColumn("level", F.sum("change").over(upto))
    return levels.filter("at IS NOT NULL AND change > 0").select(IP, F.col("at").alias(TIME), "level", F.col("change").alias("n"))


def _places(rows: DataFrame, crowd: int) -> DataFrame:
    """Adds `place` to rows with `n`: the rank of an order by id among the n of its address and time.

    Orders with one id, or none, share the last of their places; none comes first. Orders are ranked by one window over
    their address and time, but for crowds of more than `crowd`.
    """
    of_moment = Window.partitionBy(IP, TIME).orderBy(ORDER).rangeBetween(Window.unboundedPreceding, 0)
    few = rows.filter(F.col("n") <= crowd).withColumn("place", F.count("*").over(of_moment))
    return few.unionByName(_places_in_crowds(rows.filter(F.col("n") > crowd)))


def _places_in_crowds(rows: DataFrame) -> DataFrame:
    """The same for crowds: cut at about SPLITS of their ids, those with certain hashes, so whatever the ids look like,
    the pieces are ranked in different tasks and start with the sizes of the pieces before."""
    picked = F.pmod(F.xxhash64(ORDER), F.col("n")) < SPLITS
    splits = rows.filter(picked).groupBy(IP, TIME).agg(F.array_sort(F.collect_set(ORDER)).alias("splits"))
    piece = F.coalesce(F.size(F.filter("splits", lambda s: s < F.col(ORDER))), F.lit(0))
    cut = rows.join(splits, [IP, TIME], "left").withColumn("piece", piece)
    of_piece = Window.partitionBy(IP, TIME, "piece").orderBy(ORDER).rangeBetween(Window.unboundedPreceding, 0)
    ranked = cut.withColumn("place", F.count("*").over(of_piece))
    sizes = cut.groupBy(IP, TIME, "piece").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy(IP, TIME).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select(IP, TIME, "piece", F.sum("size").over(earlier).alias("ahead"))
    placed = ranked.join(ahead, [IP, TIME, "piece"], "left")
    return placed.select(*rows.columns, (F.col("place") + F.coalesce("ahead", F.lit(0))).alias("place"))


def rolling_ip_count(
    df: DataFrame,
    look_back: str = "10 minutes",
    ties: str = "peers",
    cells: int = 10,
    crowd: int = 10_000,
) -> DataFrame:
    """Adds `recent_orders`: the orders of the same address in the look-back, this one included.

    An order exactly one look-back old is out. Orders at the same time count each other ("peers"), or
    only those before them by order id ("arrival"), an order without an id first. An order without address or
    time has no count. More than `crowd` orders of one address at one time are ranked in pieces.

    Work is split by address and time cell, `cells` to a look-back.

    For tables. Counts come first and are then joined to the orders, so an address, a time or a copied
    order that holds a large part of all rows is added up before it is shuffled.
    """
    if df.isStreaming:
        raise ValueError("on a stream use rolling_ip_count_stream")
    if ties not in ("peers", "arrival"):
        raise ValueError("ties is 'peers' or 'arrival'")
    timed = F.col(IP).isNotNull() & F.col(TIME).isNotNull()
    known = df.filter(timed)
    moments = known.groupBy(IP, TIME).agg(F.count("*").alias("n"))
    levels = _levels(moments, look_back, cells)
    if ties == "peers":
        return df.join(levels, [IP, TIME], "left").select(*df.columns, F.col("level").alias("recent_orders"))
    # Of the level at its time, an order keeps what came before that time and its place at it.
    placed = _places(known.join(levels, [IP, TIME]), crowd)
    counted = placed.withColumn("recent_orders", F.col("level") - F.col("n") + F.col("place"))
    rest = df.filter(~timed).withColumn("recent_orders", F.lit(None).cast("bigint"))
    return counted.select(*df.columns, "recent_orders").unionByName(rest)


def order_verdict(df: DataFrame, limit: int = 10, threshold: int = 500_000) -> DataFrame:
    """Adds one verdict per order: macro before high_value before normal."""
    verdict = (
        F.when(F.col("recent_orders") >= limit, "macro")
        .when(F.col("total_price") >= threshold, "high_value")
        .otherwise("normal")
    )
    return df.withColumn("verdict", verdict)
