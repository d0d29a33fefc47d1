"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "popular_actor_extract",
    "daily_category_counts",
    "corr_matrix",
    "categorise_events",
    "actor_frequencies",
    "token_counts",
    "vocab_by_coverage",
    "multi_hot_tokens",
    "assemble_training_set",
    "cluster_profile",
    "actor_event_graph",
    "kmeans_cosine",
    "kmeans_sweep",
    "closest_per_cluster",
    "closest_n_per_cluster",
    "diverse_closest_per_cluster",
    "extract_paragraph_text",
    "first_text_per_row",
    "summarise_representatives",
    "read_zipped_members",
    "append_table",
    "on_new_file",
]


def zip_files(lines, folder: str) -> float:
    """Each Arrow batch of lines as an archive with one CSV member below ``folder``; MB of text."""
    import pandas as pd

    def pack(batches):
        import io
        import uuid
        import zipfile

        for batch in batches:
            text = "\n".join(batch["line"]) + "\n"
            name = uuid.uuid4().hex
            target = io.BytesIO()
            with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(f"{name}.CSV", text)
            with open(f"{folder}/{name}.CSV.zip", "wb") as out:
                out.write(target.getvalue())
            yield pd.DataFrame({"size": [len(text.encode())]})

    os.makedirs(folder)
    return lines.mapInPandas(pack, "size long").groupBy().sum("size").first()[0] / 1e6


def ingestion_rate(spark, rows, schema, folder: str, runs: int = 3) -> dict:
    """Zipped files of all columns to the typed table: MB of unzipped text per second, median of the runs."""
    from pyspark.sql import functions as F

    from eventloom.session import settle
    from eventloom.sources.readers import split_quarantine
    from eventloom.sources.sinks import append_table
    from eventloom.sources.zips import read_zipped_members

    cells = [F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in schema.fields]
    lines = settle(rows.select(F.concat_ws("\t", *cells).alias("line")))
    size = zip_files(lines.repartition(32), f"{folder}/zips")
    took = []
    for run in range(runs):
        started = time.time()
        good, _ = split_quarantine(read_zipped_members(spark, f"{folder}/zips", schema))
        append_table(good, f"{folder}/table")
        took.append(time.time() - started)
    took = sorted(took)[runs // 2]
    return {"mb": round(size, 1), "sec": round(took, 2), "mb_per_sec": round(size / took, 1)}


def ingestion_rates(spark, sf_dir: str, folder: str) -> dict:
    from pyspark.sql import functions as F

    from eventloom.catalog.ingestion import _as_events_file, gkg_rows
    from eventloom.catalog.registry import activity
    from eventloom.schemas import EVENTS, GKG

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000000")
    many = F.explode(F.sequence(F.lit(1), F.lit(16)))
    url = F.concat(F.lit("http://news.example.org/a/"), "GLOBALEVENTID")
    events = activity(spark, sf_dir).withColumn("n", many).withColumn("SOURCEURL", url)
    gkg = gkg_rows(spark, sf_dir).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2))))
    return {
        "events": ingestion_rate(spark, _as_events_file(events), EVENTS, f"{folder}/events"),
        "gkg": ingestion_rate(spark, gkg, GKG, f"{folder}/gkg"),
    }


def main() -> None:
    from eventloom.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": f"{folder}/shared",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    from eventloom.catalog import QUERIES

    QUERIES["daily_category_counts"](spark, sf_dir).collect()  # warm-up
    times = {}
    for name in HEADLINE:
        started = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 3)
    rate = ingestion_rates(spark, sf_dir, folder)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "ingestion": rate,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
