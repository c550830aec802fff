"""Collection: a ledger of what was fetched, retries, pauses, deletions and the report of a run."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.error import HTTPError
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.operators.relational import not_in
from lathework.shipping import ship

KEYS = ["source_id", "item_id"]


def delays(base: float, tries: int) -> list[float]:
    """Waits before the repeated tries, each twice the one before."""
    return [base * 2**k for k in range(tries)]


def attempt(work: Callable[[], object], waits: list[float], sleep: Callable[[float], None] = time.sleep) -> tuple[object, str | None]:
    """Result of ``work``, or the last error after all waits."""
    error = None
    for wait in [0.0, *waits]:
        if wait:
            sleep(wait)
        try:
            return work(), None
        except OSError as e:
            error = f"{type(e).__name__}: {e}"
    return None, error


def resume(open_from: Callable[[int], tuple[bool, Iterator[bytes]]], to: Path) -> Path:
    """Downloads to ``to`` by way of a part file, which a later try goes on with.

    ``open_from`` gets the number of bytes that are there and tells whether the source goes on from them, with the
    bytes; if it can't, all are fetched again. The file appears under its name only when it is whole.
    """
    part = to.with_name(f"{to.name}.part")
    part.parent.mkdir(parents=True, exist_ok=True)
    have = part.stat().st_size if part.exists() else 0
    goes_on, data = open_from(have)
    with part.open("ab" if goes_on and have else "wb") as f:
        for piece in data:
            f.write(piece)
    return part.replace(to)


def over_http(url: str, timeout: float = 30.0, size: int = 1 << 16) -> Callable[[int], tuple[bool, Iterator[bytes]]]:
    """Bytes of a url for ``resume``: a range request where something is there, the whole if the server has no such range."""

    def ask(headers: dict[str, str]):
        return urlopen(Request(url, headers=headers), timeout=timeout)

    def open_from(have: int) -> tuple[bool, Iterator[bytes]]:
        try:
            answer = ask({"Range": f"bytes={have}-"} if have else {})
        except HTTPError as e:
            if e.code != 416:
                raise
            answer = ask({})
        return answer.status == 206, iter(lambda: answer.read(size), b"")

    return open_from


def pending(items: DataFrame, ledger: DataFrame, paused: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """Items to fetch: not in the ledger, not of a paused source; the first ``most`` by key, if given."""
    out = not_in(items, ledger, KEYS)
    if paused is not None:
        out = not_in(out, paused, ["source_id"])
    return out.orderBy(*KEYS).limit(most) if most is not None else out


def fetch(items: DataFrame, get: Callable[[str], bytes], waits: list[float]) -> DataFrame:
    """Fetches each item on the executors, a source's items one after another: digest and size, or the error."""
    ship(items.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                data, error = attempt(lambda url=r.url: get(url), waits)
                rows.append((r.source_id, r.item_id, r.url, None if data is None else hashlib.sha256(data).hexdigest(), None if data is None else len(data), error))
            yield pd.DataFrame(rows, columns=["source_id", "item_id", "url", "sha256", "size_bytes", "error"]).astype({"size_bytes": "Int64"})

    by_source = items.select(*KEYS, "url").repartition("source_id").sortWithinPartitions(*KEYS)
    return by_source.mapInPandas(run, "source_id string, item_id string, url string, sha256 string, size_bytes long, error string")


def remove(ledger: DataFrame, requests: DataFrame, folder: Path | None = None) -> DataFrame:
    """The ledger without the requested items, whose files go too if their folder is given."""
    if folder is not None:
        gone = ledger.join(requests.select(KEYS), KEYS, "left_semi").select("path").collect()  # a request names its items
        for r in gone:
            (folder / r.path).unlink(missing_ok=True)
    return not_in(ledger, requests, KEYS)


def report(items: DataFrame, ledger: DataFrame, fetched: DataFrame) -> DataFrame:
    """Counts by source: discovered, skipped as known, downloaded, failed."""
    known = ledger.select(*KEYS, F.lit(1).alias("known"))
    got = fetched.select(*KEYS, F.col("error").isNull().alias("ok"))
    both = items.join(known, KEYS, "left").join(got, KEYS, "left")
    return both.groupBy("source_id").agg(F.count("*").alias("discovered"), F.count("known").alias("skipped"), F.count_if("ok").alias("downloaded"), F.count_if(~F.col("ok")).alias("failed"))
