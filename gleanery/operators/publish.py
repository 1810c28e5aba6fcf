"""Verified publishing: staged, read back, compared by digest, recorded in a ledger."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from hashlib import sha256

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleanery.operators.aggregates import constraints
from gleanery.operators.identity import digest, digest_parts
from gleanery.operators.joins import compare, orphans


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _read(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(b & 0xFF for b in stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, text: str) -> None:
    """The file whole or not at all: written beside it and renamed over it."""
    fs, p = _fs(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, p, over)


def _stage(df: DataFrame, path: str, columns: Sequence[str], compression: str) -> tuple[str, dict]:
    """The staging folder and digest of ``df`` once written beside ``path`` and read back.

    What is written is counted by the job that writes it, so the plan of ``df`` runs once.
    """
    spark, staging, seen = df.sparkSession, f"{path}.staging-{uuid.uuid4().hex}", Observation()
    watched = df.observe(seen, *digest_parts(df, columns))
    watched.write.option("compression", compression).parquet(staging)
    before, after = (named(x) for x in (seen.get, digest(spark.read.schema(df.schema).parquet(staging), columns).first().asDict()))
    if before != after:
        raise ValueError(f"read back {after}, wrote {before}")
    return staging, after


def named(parts: dict) -> dict:
    """A digest as it stands in manifests."""
    return {"n_rows": parts["n_rows"], "digest": str(parts["digest"] or 0)}


def stage_and_verify(df: DataFrame, path: str, columns: Sequence[str], compression: str = "zstd") -> dict:
    """Writes ``df`` to a new folder, reads it back, compares digests and writes the manifest last.

    An existing folder is refused; a folder without manifest was never published.
    """
    spark = df.sparkSession
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    return _settle(spark, *_stage(df, path, columns, compression), path, columns)


def _settle(spark: SparkSession, staging: str, after: dict, path: str, columns: Sequence[str]) -> dict:
    fs, p = _fs(spark, path)
    if not fs.rename(_fs(spark, staging)[1], p):
        raise OSError(f"cannot publish {path}")
    manifest = {"columns": list(columns), **after}
    _write(spark, f"{path}/_manifest.json", json.dumps(manifest, sort_keys=True))
    return manifest


def load_decision(current: dict | None, fingerprint: str, content: str) -> str:
    """published, verified_noop or republished_after_content_drift."""
    if current and current["fingerprint"] == fingerprint:
        return "verified_noop" if current["content"] == content else "republished_after_content_drift"
    return "published"


def publish(df: DataFrame, root: str, name: str, fingerprint: str, columns: Sequence[str]) -> str:
    """Loads a version of a table and moves the pointer of readers, if anything changed.

    The ledger keeps every run; a run that was left running is closed as failed by the next one.
    Readers follow ``current.json`` and see the old version until it is swapped.
    """
    spark = df.sparkSession
    ledger = json.loads(_read(spark, f"{root}/{name}/ledger.json") or "[]")
    for run in ledger:
        if run["state"] == "running":
            run |= {"state": "failed", "reason": "abandoned_session"}
    pointer = _read(spark, f"{root}/{name}/current.json")
    run = {"run": uuid.uuid4().hex, "state": "running", "fingerprint": fingerprint}
    version = f"{root}/{name}/v-{run['run']}"
    _write(spark, f"{root}/{name}/ledger.json", json.dumps([*ledger, run]))
    staging, after = _stage(df, version, columns, "zstd")
    content = "{n_rows}:{digest}".format(**after)
    decision = load_decision(json.loads(pointer) if pointer else None, fingerprint, content)
    run |= {"decision": decision, "content": content}
    if decision == "verified_noop":
        fs, p = _fs(spark, staging)
        fs.delete(p, True)
    else:
        _settle(spark, staging, after, version, columns)
        _write(spark, f"{root}/{name}/current.json", json.dumps({"version": version, "fingerprint": fingerprint, "content": content}))
    _write(spark, f"{root}/{name}/ledger.json", json.dumps([*ledger, run | {"state": "published"}]))
    return decision


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The version readers see."""
    pointer = _read(spark, f"{root}/{name}/current.json")
    if pointer is None:
        raise FileNotFoundError(f"{root}/{name}")
    return spark.read.parquet(json.loads(pointer)["version"])


def register(registry: DataFrame, new: DataFrame, key: str, facts: Sequence[str]) -> DataFrame:
    """The registry with new keys inserted; a key registered before must have the same facts."""
    old = registry.select(key, *[F.col(c).alias(f"__{c}") for c in facts])
    clash = F.lit(False)
    for c in facts:
        clash = clash | ~F.col(c).eqNullSafe(F.col(f"__{c}"))
    bad = new.join(old, key).where(clash)
    if not bad.isEmpty():
        raise ValueError(f"registered before with other facts: {bad.select(key).first()[0]}")
    return registry.unionByName(new.select(*registry.columns).join(registry.select(key), key, "left_anti"))


def checksum(text: str) -> str:
    return sha256(" ".join(text.split()).encode()).hexdigest()


def migrate(spark: SparkSession, root: str, steps: Sequence[tuple[str, str]]) -> list[str]:
    """Runs the SQL steps (name, statement) that the ledger does not hold, in order, and returns their names.

    A step the ledger holds with another checksum is an error, as is one that was run and is not
    listed any more; nothing is run then. White space does not count.
    """
    path = f"{root}/migrations.json"
    ledger = {x["name"]: x for x in json.loads(_read(spark, path) or "[]")}
    listed = dict(steps)
    changed = [n for n, x in ledger.items() if n not in listed or checksum(listed[n]) != x["checksum"]]
    if changed:
        raise ValueError(f"migrations changed after they were run: {changed}")
    run = []
    for name, statement in steps:
        if name not in ledger:
            spark.sql(statement)
            ledger[name] = {"name": name, "checksum": checksum(statement)}
            _write(spark, path, json.dumps(list(ledger.values())))
            run.append(name)
    return run


def unchanged_inputs(before: DataFrame, after: DataFrame) -> DataFrame:
    """``name, state`` of the input files of a run by their hashes at its start and end: same, changed,
    gone or new."""
    a, b = before.select("name", F.col("sha256").alias("a")), after.select("name", F.col("sha256").alias("b"))
    state = F.when(F.col("b").isNull(), "gone").when(F.col("a").isNull(), "new").when(F.col("a") == F.col("b"), "same").otherwise("changed")
    return a.join(b, "name", "full_outer").select("name", state.alias("state"))


def read_back(live: DataFrame, staged: DataFrame, key: str, columns: Sequence[str], children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``rule, breaks`` of a published table read back: rows missing, extra, modified or repeated
    against what was staged, columns whose counts differ, and orphans of each of ``children`` (table, key)."""
    compared = compare(staged, live, key, columns)
    state = lambda s: compared.where(F.col("state") == s)
    repeated = live.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rules = {"missing": state("missing"), "extra": state("extra"), "modified": state("modified"), "repeated": repeated}
    return constraints(rules | {f"orphans_{n}": orphans(df, k, live, key) for n, (df, k) in children.items()})


def verify_lineage(spark: SparkSession, path: str) -> DataFrame:
    """``path, n_rows, state`` of a published folder held against its manifest: verified, drifted or
    no_manifest (never published)."""
    text = _read(spark, f"{path}/_manifest.json")
    if text is None:
        return spark.createDataFrame([(path, None, "no_manifest")], "path string, n_rows long, state string")
    manifest = json.loads(text)
    held = digest(spark.read.parquet(path), manifest["columns"])
    same = (F.col("n_rows") == manifest["n_rows"]) & (F.col("digest") == manifest["digest"])
    return held.select(F.lit(path).alias("path"), "n_rows", F.when(same, "verified").otherwise("drifted").alias("state"))
