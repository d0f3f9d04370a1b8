"""Fake paged sources for tests; calls are noted in the folder that the query names."""

import os
import uuid

from topicloom.sources.connectors import PermanentError, RetryableError
from topicloom.sources.paged import fetcher


def note(folder, text):
    with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
        f.write(text)


@fetcher("cursor")
def cursor(query, token):
    folder, pages, stop = query.split("|")
    k = int(token[1:]) if token else 0
    if stop and k >= int(stop) and os.path.exists(f"{folder}/closed"):
        raise RetryableError("closed for now")
    note(folder, f"cursor {k}")
    return {"page": k}, f"c{k + 1}" if k + 1 < int(pages) else None


@fetcher("offset")
def offset(query, token):
    start, total = int(token or 0), int(query)
    return {"items": list(range(start, min(start + 10, total)))}, start + 10 if start + 10 < total else None


@fetcher("broken")
def broken(query, token):
    raise PermanentError("no key")
