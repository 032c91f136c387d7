"""The star as named, bucketed tables: written once, joined without moving the fact.

``write_star`` loads a snapshot into a schema of its own:

    silver             bucketed and sorted by productid
    dim_producto       bucketed and sorted by productid       (for the load)
    dim_producto_clave bucketed and sorted by producto_key    (for analysis)
    dim_<other>        plain
    fact               bucketed and sorted by producto_key

All have the same number of buckets, so the load's join of the snapshot to the product
dimension, and every later join of the fact to it, is a merge of buckets that lie side
by side: no exchange and no sort on either side, however large both get.  A product has
at most one row a day, so no bucket is skewed by a product.  The other dimensions are
small next to the fact and joined as their measured size allows.

The dimensions do not depend on each other and are loaded side by side.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfwise.plans import gold as G
from shelfwise.session import path_exists, scratch_path
from shelfwise.sources import catalog as CT


@dataclass(frozen=True)
class Star:
    """A schema of named tables (``schema``) in a folder."""
    spark: SparkSession
    schema: str
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.schema}.{name}")

    @property
    def silver(self) -> DataFrame:
        return self.table("silver")

    @property
    def fact(self) -> DataFrame:
        return self.table("fact")

    def dims(self, by_key: bool = False) -> dict[str, DataFrame]:
        """The dimensions; the product bucketed by its natural key, or by its
        surrogate key for joins to the fact."""
        names = {n: f"dim_{n}" for n in (*G.DIMENSIONS, "etiquetado")}
        if by_key:
            names["producto"] = "dim_producto_clave"
        return {n: self.table(t) for n, t in names.items()}

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.folder}/fact/_SUCCESS")


def _write_bucketed(df: DataFrame, star: Star, name: str, key: str, buckets: int, moved: bool = True) -> None:
    """One file for each bucket: rows are brought together by the same hash first,
    unless they lie so already."""
    (df.repartition(buckets, key) if moved else df).write.bucketBy(buckets, key).sortBy(key) \
        .option("path", f"{star.folder}/{name}").saveAsTable(f"{star.schema}.{name}")


def _write_plain(df: DataFrame, star: Star, name: str) -> None:
    df.write.option("path", f"{star.folder}/{name}").saveAsTable(f"{star.schema}.{name}")


def new_star(spark: SparkSession, kind: str = "star") -> Star:
    """An empty schema in a new folder of the shared scratch space."""
    folder = scratch_path(spark, kind)
    schema = folder.rsplit("/", 1)[1].replace("-", "_")
    CT.create_schema(spark, schema, folder)
    return Star(spark, schema, folder)


def load_dimensions(star: Star, snapshot: DataFrame, buckets: int) -> None:
    """Silver and the keyed dimensions."""
    _write_bucketed(snapshot, star, "silver", "productid", buckets)

    def load(name: str) -> None:
        key, natural, builder = G.DIMENSIONS[name]
        _write_plain(builder(star.silver), star, f"members_{name}")  # read twice: to count, to number
        rows = G.number_members(None, star.table(f"members_{name}"), key, natural)
        if name == "producto":
            _write_bucketed(rows, star, "dim_producto", "productid", buckets)
            _write_bucketed(star.table("dim_producto"), star, "dim_producto_clave", key, buckets)
        else:
            _write_plain(rows, star, f"dim_{name}")
    # one thread for each dimension only starts its jobs, the executors do the work
    with ThreadPoolExecutor(len(G.DIMENSIONS) + 1) as pool:
        jobs = [pool.submit(load, n) for n in G.DIMENSIONS]
        jobs.append(pool.submit(_write_plain, G.label_junk(star.spark), star, "dim_etiquetado"))
        for j in jobs:
            j.result()


def write_star(spark: SparkSession, snapshot: DataFrame, buckets: int | None = None,
               fact: bool = True) -> Star:
    """Load ``snapshot`` into a new star.  ``buckets`` (default: the session's shuffle
    partitions) should leave a few hundred MB of fact rows in each."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    star = new_star(spark)
    load_dimensions(star, snapshot, buckets)
    if fact:
        _write_bucketed(G.fact_rows(star.silver, star.dims()), star, "fact", "producto_key", buckets)
    return star


_WRITTEN: dict[tuple[str, str], Star] = {}


def star_of(spark: SparkSession, source: str, snapshot) -> Star:
    """The star of a source folder, written by the first query of the application that
    asks for it (``snapshot()`` gives its rows) and read by all others, as a lake's star
    is.  Loads do not come here: they write their own."""
    key = (spark.sparkContext.applicationId, source.rstrip("/"))
    if key not in _WRITTEN or not _WRITTEN[key].exists():
        _WRITTEN[key] = write_star(spark, snapshot())
    return _WRITTEN[key]
