"""Are pictures still there: probing addresses at a bounded rate, shares with intervals."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.graph import stratified_sample, wilson


def head(url: str) -> int:
    """Status of a HEAD request; 0 where none came."""
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(urllib.request.Request(url, method="HEAD"), timeout=10) as r:  # noqa: S310
            return r.status
    except urllib.error.HTTPError as e:
        return e.code
    except OSError:
        return 0


def probed(urls: DataFrame, probe: Callable[[str], int] = head, per_second: float = 5.0, tasks: int = 4) -> DataFrame:
    """urls with status; each of the tasks asks at most per_second / tasks times a second."""
    pause = tasks / per_second

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for u in b["url"]:
                began = time.monotonic()
                out.append(probe(u) if isinstance(u, str) else 0)
                time.sleep(max(0.0, pause - (time.monotonic() - began)))
            yield b.assign(status=pd.Series(out, index=b.index, dtype="int32"))

    return urls.repartition(tasks).mapInPandas(run, ", ".join(f"`{n}` {t}" for n, t in urls.dtypes) + ", status int")


def dead_links(images: DataFrame, stratum: str, n: int, probe: Callable[[str], int] = head, per_second: float = 5.0) -> DataFrame:
    """stratum, asked, dead, share, low, high of a fixed sample of addresses of each stratum."""
    sample = stratified_sample(images.filter("url IS NOT NULL"), stratum, "url", n)
    per = probed(sample, probe, per_second).groupBy(stratum).agg(F.count(F.lit(1)).alias("asked"), F.count_if(~F.col("status").between(200, 399)).alias("dead"))
    low, high = wilson(F.col("dead"), F.col("asked"))
    return per.select(stratum, "asked", "dead", (F.col("dead") / F.col("asked")).alias("share"), low.alias("low"), high.alias("high"))


def fetched(urls: DataFrame, fetch: Callable[[str], bytes], done: DataFrame | None = None) -> DataFrame:
    """url, content, error: pictures not in ``done`` yet (url); a failure is a row with its reason, so that a later run can go on."""
    todo = urls.select("url").filter("url IS NOT NULL").distinct()
    if done is not None:
        todo = todo.join(done.select("url").distinct(), "url", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for u in b["url"]:
                try:
                    rows.append((u, fetch(u), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((u, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["url", "content", "error"])

    return todo.mapInPandas(run, "url string, content binary, error string")
