"""What happens to a graph after it is built: filtering to three modalities, signals, subjects, address and link quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def trimodal(link: DataFrame, text: DataFrame, image: DataFrame) -> DataFrame:
    """link rows of products that have a text and a picture too. Each: product_id."""
    ids = lambda t: t.filter("product_id IS NOT NULL").select("product_id").distinct()
    return link.join(ids(text), "product_id", "left_semi").join(ids(image), "product_id", "left_semi")


def retention(kg: DataFrame, link: DataFrame, text: DataFrame, image: DataFrame) -> DataFrame:
    """One row: before (products of link), with_text, with_image, after (with both), retention. Each by product_id."""
    own = link.filter("product_id IS NOT NULL").select("product_id").distinct()
    mark = lambda t, name: t.filter("product_id IS NOT NULL").select("product_id").distinct().withColumn(name, F.lit(1))
    j = own.join(mark(text, "t"), "product_id", "left").join(mark(image, "i"), "product_id", "left").join(mark(kg, "k"), "product_id", "left")
    both = F.col("t").isNotNull() & F.col("i").isNotNull()
    return j.agg(
        F.count(F.lit(1)).alias("before"), F.count("t").alias("with_text"), F.count("i").alias("with_image"), F.count_if(both).alias("after"), F.count_if(both & F.col("k").isNotNull()).alias("after_with_triples"),
    ).withColumn("retention", F.round(F.col("after") / F.greatest(F.col("before"), F.lit(1)), 4))


def kept_triples(kg: DataFrame, link: DataFrame) -> DataFrame:
    """Triples of the products in link; both by product_id."""
    return kg.join(link.select("product_id").distinct(), "product_id", "left_semi")


def signal_split(kg: DataFrame, signals: list[str]) -> tuple[DataFrame, DataFrame]:
    """(graph, signals): relations about buyers' behaviour go to a table of their own."""
    return kg.filter(F.col("relation").isNull() | ~F.col("relation").isin(signals)), kg.filter(F.col("relation").isin(signals))


def plain_subject(c: Column) -> Column:
    """Subject without a leading # or blank, which would make it a comment."""
    return F.regexp_replace(c, r"^[#\s]+", "")


def coverage(kg: DataFrame, link: DataFrame, text: DataFrame, image: DataFrame) -> DataFrame:
    """One row: products, with_text, with_image, with_both (shares), without_triples, homonyms. All by product_id."""
    ids = link.filter("product_id IS NOT NULL").groupBy("product_id").agg(F.max("n_homonyms").alias("n_homonyms"))
    mark = lambda t, name: t.filter("product_id IS NOT NULL").select("product_id").distinct().withColumn(name, F.lit(1))
    all_ = ids.join(mark(text, "t"), "product_id", "left").join(mark(image, "i"), "product_id", "left").join(mark(kg, "k"), "product_id", "left")
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    has = lambda c: F.col(c).isNotNull()
    return all_.agg(
        F.count(F.lit(1)).alias("products"), share(has("t")).alias("with_text"), share(has("i")).alias("with_image"), share(has("t") & has("i")).alias("with_both"),
        F.count_if(~has("k")).alias("without_triples"), F.count_if(F.col("n_homonyms") > 1).alias("homonyms"),
    )


#: Form of an address of a picture: host and name are its groups. Hosts that answer, and the form of a product's id, which is no picture's name.
PICTURE, HOSTS, PRODUCT = r"^https://([^/]+)/i/([A-Za-z0-9]+)(?:\._[A-Za-z0-9,]+_)?\.(?:jpg|jpeg|png)$", r"^img\d+\.shop\.example$", r"^Q[A-Z0-9]{7}$"


def url_reason(url: Column, form: str = PICTURE, hosts: str = HOSTS, product: str = PRODUCT) -> Column:
    """The first fault of an address: not an address, insecure, unexpected form, unknown host, a product's id as name; null if none."""
    part = lambda i: F.regexp_extract(url, form, i)
    return (
        F.when(url.isNull() | ~F.startswith(url, F.lit("http")), "not http").when(F.startswith(url, F.lit("http://")), "insecure").when(~url.rlike(form), "unexpected form")
        .when(~part(1).rlike(hosts), "unknown host").when(part(2).rlike(product), "id as name")
    )


def url_faults(image: DataFrame) -> DataFrame:
    """reason, n_rows, n_products, example (the first by code point)."""
    return image.withColumn("reason", url_reason(F.col("url"))).filter("reason IS NOT NULL").groupBy("reason").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("product_id").alias("n_products"), F.min("url").alias("example")
    )


def image_form(image: DataFrame, link: DataFrame) -> DataFrame:
    """variant, n_rows, n_products, n_faulty, coverage: pictures by variant and in all (variant null), and the share of the products of link that
    they cover. Both by product_id."""
    expected = link.filter("product_id IS NOT NULL").agg(F.count_distinct("product_id").alias("expected"))
    stats = image.withColumn("faulty", url_reason(F.col("url")).isNotNull()).rollup("variant").agg(
        F.grouping("variant").alias("all_variants"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("product_id").alias("n_products"), F.count_if("faulty").alias("n_faulty")
    )
    named = stats.select(F.when(F.col("all_variants") == 1, F.lit("(all)")).otherwise(F.coalesce("variant", F.lit("(none)"))).alias("variant"), "n_rows", "n_products", "n_faulty")
    return named.crossJoin(F.broadcast(expected)).select(  # one row
        "variant", "n_rows", "n_products", "n_faulty", F.when(F.col("expected") > 0, F.round(100 * F.col("n_products") / F.col("expected"), 1)).otherwise(0.0).alias("coverage")
    )


def stratified_sample(rows: DataFrame, stratum: str, key: str, n: int, seed: int = 13) -> DataFrame:
    """n rows of each stratum, the ones with the smallest hash of seed and key: always the same, and any larger n holds a smaller one's rows."""
    draw = F.struct(F.xxhash64(F.lit(seed), F.col(key)), F.col(key))
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy(draw)))
    return ranked.filter(F.col("_r") <= n).drop("_r")


def wilson(hits: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Bounds of the 95 % interval of a share, within 0 and 1; both 0 for no trials."""
    p = hits / F.nullif(n, F.lit(0))
    d = 1 + z * z / n
    middle, half = (p + z * z / (2 * n)) / d, z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / d
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    safe = lambda c: F.when(n > 0, c)
    return zero(safe(F.greatest(F.lit(0.0), middle - half))), zero(safe(F.least(F.lit(1.0), middle + half)))


def seed_summary(results: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, runs, mean, deviation (of the sample; null for one run)."""
    return results.groupBy(*keys).agg(F.count(value).alias("runs"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("deviation"))
