"""Payloads over HTTP: requests with retries, and a data source that reads a table of addresses in parallel."""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tries of a request.
TRIES = 3


@dataclass(frozen=True)
class Client:
    """Settings of requests.  Certificates are always checked."""

    headers: Mapping[str, str] = field(default_factory=dict)
    proxy: str = ""
    timeout: float = 60.0

    def open(self, url: str, data: bytes | None) -> tuple[str, int]:
        handlers = [urllib.request.ProxyHandler({"http": self.proxy, "https": self.proxy})] if self.proxy else []
        request = urllib.request.Request(url, data, dict(self.headers))
        try:
            with urllib.request.build_opener(*handlers).open(request, timeout=self.timeout) as response:
                return response.read().decode("utf-8", "replace"), response.status
        except urllib.error.HTTPError as e:
            return "", e.code


Opener = Callable[[str, bytes | None], tuple[str, int]]


def get_text(url: str, opener: Opener, tries: int = TRIES, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, int | None]:
    """Text and status: 404 at once with an empty text; other statuses than 200 are tried again after a growing wait; (None, None) at last."""
    for k in range(1, tries + 1):
        try:
            text, status = opener(url, None)
        except OSError:
            continue
        if status == 404:
            return "", 404
        if status == 200:
            return text, 200
        sleep(float(k))
    return None, None


def post_form(url: str, form: Mapping[str, str] | list[tuple[str, str]], opener: Opener, tries: int = TRIES) -> tuple[str | None, int | None]:
    """As get_text, without a wait and without an exception for 404."""
    data = urllib.parse.urlencode(form).encode()
    for _ in range(tries):
        try:
            text, status = opener(url, data)
        except OSError:
            continue
        if status == 200:
            return text, 200
    return None, None


def fetch(addresses: DataFrame, client: Client | None = None, url_col: str = "url", form_col: str = "form") -> DataFrame:
    """Adds payload and status to a table of addresses; as many requests at a time as there are tasks.

    A row with a form (an array of name and value) is posted, any other is got.  Columns of these two names are replaced.
    """
    opener = (client or Client()).open

    @F.pandas_udf("struct<payload:string,status:int>")
    def ask(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for urls, forms in batches:
            rows = []
            for url, form in zip(urls, forms, strict=True):
                pairs = None if form is None else [(f["name"], f["value"] or "") for f in form]
                rows.append((None, None) if not url else get_text(url, opener) if pairs is None else post_form(url, pairs, opener))
            yield pd.DataFrame(rows, columns=["payload", "status"])

    form = F.col(form_col) if form_col in addresses.columns else F.lit(None).cast("array<struct<name:string,value:string>>")
    kept = [c for c in addresses.columns if c not in ("payload", "status", form_col)]
    return addresses.withColumn("_got", ask(F.col(url_col), form)).select(*kept, "_got.payload", "_got.status")
