"""Data checks: row counts, checksums and distributions."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.payload import price

# A sum of prices, as Spark types it.
_TOTAL = "decimal(35,6)"


def kind_checksums(df: DataFrame, kind: str = "event_type") -> DataFrame:
    """Rows and price sum per event kind, the whole part of the exact sum."""
    total = F.sum(price(F.col("item_price"))).try_cast("bigint")
    return df.groupBy(kind).agg(F.count("*").alias("n_rows"), total.alias("price_checksum"))


def observed(seen: Observation, df: DataFrame, metrics: Sequence[Column]) -> dict:
    """Observed ``metrics`` of ``df`` once its write has ended.

    Where nothing was left to write, adaptive execution may have planned the
    observation away with the rest; only then ``df`` is read for them.
    """
    try:
        return seen.get
    except Py4JJavaError:
        return df.agg(*metrics).first().asDict()


class KindChecks:
    """``kind_checksums`` taken while the rows pass by, in the job that writes them.

    ``kinds`` are told apart; all others, a null kind among them, are counted
    together as ``rest``, so no row is left out.  The sums are observed metrics:
    they cost no second read and no shuffle.
    """

    def __init__(self, kinds: Sequence[str], kind: str = "event_type", name: str = "kind_checks"):
        self.kinds, self.kind, self.name = list(kinds), kind, name
        self._seen: Observation | None = None
        self._df: DataFrame | None = None

    def _metrics(self) -> list[Column]:
        kind, value = F.col(self.kind), price(F.col("item_price"))
        own = [kind.eqNullSafe(k) for k in self.kinds]
        own.append(~F.coalesce(kind.isin(self.kinds), F.lit(False)))
        counts = [F.count_if(c).alias(f"n_{i}") for i, c in enumerate(own)]
        sums = [F.sum(F.when(c, value)).alias(f"price_{i}") for i, c in enumerate(own)]
        return [*counts, *sums]

    def watch(self, df: DataFrame) -> DataFrame:
        """``df``, to be written next; a stream reports to ``KindTotals`` instead."""
        if df.isStreaming:
            return df.observe(self.name, *self._metrics())
        self._seen, self._df = Observation(self.name), df
        return df.observe(self._seen, *self._metrics())

    def rows(self, found: dict) -> list[tuple]:
        """(kind, rows, price sum) of the kinds that were seen, from the observed metrics."""
        names = [*self.kinds, None]
        every = [(name, found[f"n_{i}"], found[f"price_{i}"]) for i, name in enumerate(names)]
        return [row for row in every if row[1]]

    def result(self, spark: SparkSession) -> DataFrame:
        """The rows of ``kind_checksums`` once the write has ended; the kind of the rest is null."""
        return checksum_rows(spark, self.rows(observed(self._seen, self._df, self._metrics())), self.kind)


class KindTotals(StreamingQueryListener):
    """Adds up the metrics of ``KindChecks`` over the micro-batches of a stream.

    Register it with ``spark.streams.addListener`` before the stream starts.  A
    batch that runs again counts once: the last report of a batch is taken.
    """

    def __init__(self, checks: KindChecks):
        self.checks = checks
        self._batches: dict[tuple[str, int], list[tuple]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found: Row | None = event.progress.observedMetrics.get(self.checks.name)
        if found is not None:
            batch = (str(event.progress.id), event.progress.batchId)
            self._batches[batch] = self.checks.rows(found.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def result(self, spark: SparkSession) -> DataFrame:
        totals: dict = {}
        for rows in self._batches.values():
            for kind, n, value in rows:
                before = totals.get(kind, (0, None))
                total = value if before[1] is None else before[1] if value is None else before[1] + value
                totals[kind] = (before[0] + n, total)
        return checksum_rows(spark, [(k, *v) for k, v in totals.items()], self.checks.kind)


def checksum_rows(spark: SparkSession, rows: list[tuple], kind: str) -> DataFrame:
    df = spark.createDataFrame(rows, f"{kind} string, n_rows bigint, total {_TOTAL}")
    return df.select(kind, "n_rows", F.col("total").try_cast("bigint").alias("price_checksum"))


def reconcile(sent: DataFrame, received: DataFrame, kind: str = "event_type") -> DataFrame:
    """Rows per kind on both sides and whether they agree.

    A null kind stands for messages that could not be decoded.
    """
    def side(df: DataFrame, s: int, r: int) -> DataFrame:
        return df.select(kind, F.lit(s).alias("s"), F.lit(r).alias("r"))

    both = side(sent, 1, 0).unionByName(side(received, 0, 1))
    totals = both.groupBy(kind).agg(F.sum("s").alias("n_sent"), F.sum("r").alias("n_received"))
    return totals.withColumn("agree", F.col("n_sent") == F.col("n_received"))


def bucket_distribution(df: DataFrame) -> DataFrame:
    """Users per gender and age category."""
    return df.groupBy("gender", "age_cat").agg(F.count("*").alias("n_users"))
