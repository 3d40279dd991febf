"""Stages that are skipped when their output is complete, by a manifest beside it, in any store that Spark reaches."""

from __future__ import annotations

import json
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from kinweave.sources.store import Store

MANIFEST = "_manifest.json"


def guarded(store: Store, path: str, root: str) -> str:
    """The full path, which must lie inside ``root``."""
    full, top = store.full(path), store.full(root).rstrip("/") + "/"
    if not full.startswith(top):
        raise ValueError(f"{full} is not inside {top}")
    return full


def _files(store: Store, path: str) -> list[dict]:
    held = {k: n for k, n in store.sizes(path).items() if not k.rsplit("/", 1)[-1].startswith(("_", "."))}
    return [{"name": k.rsplit("/", 1)[-1], "path": k, "bytes": held[k]} for k in sorted(held)]


def complete(store: Store, path: str, stage: str, config: dict) -> bool:
    """Whether a finished output of this stage and configuration is there, with every file at its recorded size."""
    if not store.exists(f"{path}/{MANIFEST}"):
        return False
    try:
        held = json.loads(store.read(f"{path}/{MANIFEST}"))
    except (ValueError, Py4JJavaError):  # no JSON, or bytes that fail the store's checksum
        return False
    same = held.get("complete") is True and held.get("stage") == stage and held.get("config") == json.loads(json.dumps(config))
    return bool(same and held.get("files") and held["files"] == _files(store, path))


def finish(store: Store, path: str, stage: str, config: dict, rows: int) -> dict:
    """Write the manifest at once; a missing or empty output is an error."""
    files = _files(store, path)
    if not sum(f["bytes"] for f in files):
        raise ValueError(f"{path} has no output")
    held = {"stage": stage, "config": config, "total_rows": rows, "files": files, "complete": True}
    store.write(f"{path}/{MANIFEST}", json.dumps(held, sort_keys=True))
    return held


def run_stage(spark: SparkSession, path: str, root: str, stage: str, config: dict, build: Callable[[str], int]) -> bool:
    """Build the output unless it is complete; says whether it was built. An unfinished or other output is removed before."""
    store = Store(spark)
    full = guarded(store, path, root)
    if complete(store, full, stage, config):
        return False
    store.remove(full)
    finish(store, full, stage, config, build(full))
    return True
