"""A first manifest for a table, inferred from its raw files."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlake.operators.infer import infer_manifest, manifest_of, stored_types
from rawlake.plans.ingest import text_format
from rawlake.session import configure, materialize
from rawlake.sources import remote
from rawlake.sources import scan as scans
from rawlake.sources.inventory import discover_many, sample_files
from rawlake.sources.templates import PathTemplate
from rawlake.types import type_name


def infer_table(
    spark: SparkSession, config: dict[str, Any], table: str, sample: int | None = None, seed: int = 0, path: str | None = None
) -> dict[str, Any]:
    """Infer the manifest of a table from files of all its templates.

    All files are read, whole, unless ``sample`` or the manifest's
    ``auto_detect_sample_size`` asks for so many random ones. With ``path`` the manifest
    is also written there as JSON.
    """
    configure(spark)
    spec = config.get("input", {})
    if sample is None:
        sample = config.get("manifest", {}).get("auto_detect_sample_size")
    templates = [
        PathTemplate(t, None, config.get("extract_vars"), spec.get("file_type", "date")) for t in config["tables"][table]["raw_files"]
    ]
    found = discover_many(spark, templates).where("matched")
    files = materialize(sample_files(found, sample, seed), "sample")
    if files.isEmpty():
        raise FileNotFoundError(f"No raw files for table '{table}'")
    if spec.get("format") == "parquet":
        stored = materialize(scans.footers(files), "footers")
        # Types that all files share keep the names Spark's reader gives them; one look per distinct stored schema.
        exact: dict[str, str] = {}
        for example in stored.groupBy("stored").agg(F.min(F.struct("path", "names", "types")).alias("e")).select("e.*").collect():
            have = {f.name: type_name(f.dataType) for f in spark.read.parquet(scans.escaped(example["path"])).schema}
            exact.update({kind: have[name] for name, kind in zip(example["names"], example["types"])})
        manifest = manifest_of(stored_types(stored), exact)
    else:
        fmt = text_format(spec)
        manifest = infer_manifest(scans.scan_text(files, fmt, T.StructType([]), extra="drop"), fmt.convert)
    if path is not None:
        with remote.open_output(path) as out:
            out.write(json.dumps(manifest, indent=2).encode())
    return manifest

