"""How injected functions that call a service are run: retries, statuses, one call for each partition's row in turn.

Nothing here opens a connection. A call is a function of one request that returns a :class:`Reply`; ``fetched`` runs it
over a table, so a lost executor repeats only its own calls.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: States of a service that are worth another try.
PASSING = (408, 429, 500, 502, 503, 504)


@dataclass
class Reply:
    """code 200 and a body; another code; or code 0 for a request that failed before an answer, with the reason in body."""

    code: int
    body: str = ""
    headers: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Retry:
    tries: int = 8
    longest: float = 60.0
    jitter: float = 0.25

    def wait(self, attempt: int, reply: Reply) -> float:
        """Seconds before the next try: what the service asks for, else doubling, with jitter, up to the longest."""
        asked = {k.lower(): v for k, v in reply.headers.items()}.get("retry-after", "")
        try:
            return min(max(0.0, float(asked)), self.longest)
        except ValueError:
            return min(2.0 ** (attempt - 1) * (1 + random.random() * self.jitter), self.longest)


def called(call: Callable[[str], Reply], request: str, retry: Retry = Retry(), sleep: Callable[[float], None] = time.sleep) -> tuple[str, str]:
    """(status, body) of a request: ``ok``, ``http_N`` with the first 800 characters of the body (400 after the last of
    several tries), or ``request_error:reason``. A missing page (404) is not tried again."""
    for attempt in range(1, max(1, retry.tries) + 1):
        try:
            reply = call(request)
        except Exception as e:  # the caller's own errors are an outcome of the call
            reply = Reply(0, type(e).__name__)
        passing = reply.code == 0 or reply.code in PASSING
        if not passing or attempt >= retry.tries:
            break
        sleep(retry.wait(attempt, reply))
    if reply.code == 0:
        return f"request_error:{reply.body}", ""
    if 200 <= reply.code < 300:
        return "ok", reply.body
    return f"http_{reply.code}", reply.body[: 400 if passing else 800]


def fetched(rows: DataFrame, request: str, call: Callable[[str], Reply], retry: Retry = Retry(), pause: float = 0.0) -> DataFrame:
    """rows with status and body of a call for each request; a null request has the status ``no_request``. A table of keys
    that are cached already is to be anti-joined before."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for x in b[request]:
                out.append(("no_request", "") if x is None else called(call, x, retry))
                if pause:
                    time.sleep(pause)
            yield b.assign(status=[s for s, _ in out], body=[t for _, t in out])

    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(run, f"{kinds}, status string, body string")


def pdf_status(content: Column, most: int, content_type: Column | None = None) -> Column:
    """``downloaded``, ``too_large`` or ``not_pdf`` of a binary column: a PDF has ``%PDF`` within its first 1024 bytes, or
    at least a content type that says so."""
    said = F.lit(False) if content_type is None else F.coalesce(F.contains(F.lower(content_type), F.lit("pdf")), F.lit(False))
    head = F.decode(F.substring(content, 1, 1024), "ISO-8859-1")
    return F.when(F.octet_length(content) > most, "too_large").when(F.contains(head, F.lit("%PDF")) | said, "downloaded").otherwise("not_pdf")


def pdf_name(pub: Column, url: Column) -> Column:
    """The name under which a publication's PDF is cached."""
    return F.concat(F.sha1(F.concat_ws("|", pub, url).cast("binary")), F.lit(".pdf"))


def raw_text(content: Column, most: int) -> Column:
    """The bytes of a file as text, each byte a character, cut to most: what is left where no extractor is at hand."""
    return F.substring(F.decode(content, "ISO-8859-1"), 1, most)
