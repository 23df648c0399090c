"""The job inputs, derived in full from the synthetic star-schema tables.

Every view is plain SQL that Spark and DuckDB both run; ``@name`` stands for a
base table. NULLs, gaps, odd ages, bad JSON and a broken payload are planted by
key arithmetic in CASE expressions, so no row of a base table is left out.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_class_info": """
        SELECT CAST(o_custkey AS STRING) AS patient_id,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'Lung Opacity'
                    WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'No Lung Opacity / Not Normal'
                    WHEN o_orderkey % 23 = 0 THEN NULL
                    ELSE 'Normal' END AS class
        FROM @orders""",
    "fx_headers": """
        SELECT CASE WHEN c_custkey % 37 = 0 THEN '' WHEN c_custkey % 41 = 0 THEN NULL
                    ELSE c_name END AS patient_id_raw,
               CASE WHEN c_custkey % 11 = 0 THEN NULL
                    WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'CR' ELSE 'DX' END AS modality,
               CASE c_custkey % 3 WHEN 0 THEN 'PA' WHEN 1 THEN 'AP' ELSE NULL END AS view_position,
               'CHEST' AS body_part_examined,
               CASE WHEN c_nationkey % 2 = 0 THEN 'M' ELSE 'F' END AS patient_sex,
               CASE WHEN c_custkey % 13 = 0 THEN NULL
                    WHEN c_custkey % 17 = 0 THEN ''
                    WHEN c_custkey % 19 = 0 THEN '006M'
                    ELSE lpad(CAST(CAST(floor(abs(c_acctbal) / 60) AS BIGINT) AS STRING), 3, '0') || 'Y' END
                    AS patient_age,
               CAST(1024 AS INT) AS n_rows,
               CAST(CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE 1024 END AS INT) AS n_columns,
               '1.2.3.' || CAST(c_custkey AS STRING) AS study_instance_uid,
               CASE WHEN c_custkey % 5 = 0 THEN NULL
                    ELSE '1.2.3.' || CAST(c_custkey AS STRING) || '.1' END AS series_instance_uid,
               CASE WHEN c_custkey % 7 = 3 THEN 'unlinked-' ELSE '' END || CAST(c_custkey AS STRING)
                    || CASE WHEN c_custkey % 31 = 0 THEN '.dcm.dcm' ELSE '.dcm' END AS file_name,
               'raw/' || CASE WHEN c_custkey % 7 = 3 THEN 'unlinked-' ELSE '' END || CAST(c_custkey AS STRING)
                    || CASE WHEN c_custkey % 31 = 0 THEN '.dcm.dcm' ELSE '.dcm' END AS file_path
        FROM @customer""",
    "fx_arrivals": """
        SELECT event_id AS kafka_offset, ts AS kafka_timestamp,
               CASE event_id % 10
                    WHEN 0 THEN 'not json'
                    WHEN 1 THEN '[1,2]'
                    WHEN 2 THEN '{"file_path":"raw/x.dcm","ingestion_timestamp":1.5}'
                    WHEN 3 THEN '{"patient_id":null,"file_path":"raw/n.dcm","ingestion_timestamp":2.5}'
                    ELSE '{"patient_id":"p' || CAST(user_id AS STRING) || '","file_path":"raw/'
                         || CAST(event_id AS STRING) || '.dcm","ingestion_timestamp":'
                         || CAST(1704067200 + event_id AS STRING) || '.5}' END AS value
        FROM @events""",
    "fx_files": """
        SELECT 'img' || lpad(CAST(doc_id AS STRING), 12, '0') || '.png' AS file_name, text AS content
        FROM @documents""",
    "fx_pixels": """
        SELECT vec_id AS image_id, 8 AS height, 8 AS width, embedding AS pixels, label FROM @embeddings""",
    "fx_scores": """
        SELECT event_id AS row_id, 'scan_' || CAST(event_id AS STRING) || '.png' AS filename, ts AS scored_at,
               CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
               CASE WHEN value > 300 THEN 1.0E0 ELSE value / 300.0E0 END AS probability
        FROM @events""",
    "fx_logits": """
        SELECT event_id AS row_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
               (CASE WHEN value > 300 THEN 1.0E0 ELSE value / 300.0E0 END - 0.5E0) * 8 AS logit
        FROM @events""",
    "fx_audit": """
        SELECT event_type AS job_name, ts AS run_timestamp, user_id AS row_count, props AS notes
        FROM @events""",
    "fx_run_metrics": """
        SELECT event_type AS run_name, event_id AS step,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE round(value, 0) END AS val_auroc
        FROM @events""",
    "fx_gaps": """
        SELECT row_id, CASE WHEN row_id % 11 = 0 THEN NULL ELSE label END AS label,
               CASE WHEN row_id % 7 = 0 THEN NULL ELSE probability END AS probability
        FROM (SELECT event_id AS row_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
                     CASE WHEN value > 300 THEN 1.0E0 ELSE value / 300.0E0 END AS probability
              FROM @events) e""",
    "fx_keys": """
        SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey - 20000 END AS k FROM @orders""",
    "fx_uploads": """
        SELECT page_id,
               CASE page_id % 4 WHEN 0 THEN 'text/plain' WHEN 1 THEN 'image/jpeg' ELSE 'image/png' END
                    AS content_type,
               CASE page_id % 3 WHEN 0 THEN html WHEN 1 THEN 'GIF89a' || html
                    ELSE 'GIF89a' || md5(html) END AS payload
        FROM @pages""",
}


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapter view over the parquet tables in ``sf_dir``."""
    text = re.sub(r"@(\w+)", lambda m: f"parquet.`{sf_dir}/{m.group(1)}.parquet`", VIEWS[name])
    return spark.sql(text)


def stream_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same view as a streaming frame over its one base table."""
    table = re.search(r"@(\w+)", VIEWS[name]).group(1)
    schema = base_table(spark, sf_dir, table).schema
    # A glob, as a stream does not take a single file; it also finds a table folder.
    files = spark.readStream.schema(schema).parquet(f"{sf_dir}/{table}.parque[t]")
    files.createOrReplaceTempView(f"{name}_stream")
    return spark.sql(VIEWS[name].replace(f"@{table}", f"{name}_stream"))


def duckdb_text(name: str) -> str:
    """The same view over DuckDB's registered tables."""
    return re.sub(r"@(\w+)", r"\1", VIEWS[name])
