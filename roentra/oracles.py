"""DuckDB SQL with the same results as the queries of ``workload``, written independently."""

from __future__ import annotations

import re

from roentra import schemas
from roentra.adapters import VIEWS, duckdb_text

PARTS = {
    "silver": """
        SELECT CASE WHEN patient_id_raw <> '' THEN substr(sha256(patient_id_raw), 1, 16) END AS patient_id_hash,
               replace(regexp_extract(file_path, '[^/]*$'), '.dcm', '') AS original_filename,
               modality, view_position, body_part_examined, patient_sex,
               CASE WHEN regexp_full_match(rtrim(patient_age, 'Y'), '[+-]?[0-9]+')
                    THEN CAST(CAST(rtrim(patient_age, 'Y') AS BIGINT) // 10 * 10 AS VARCHAR) || '-'
                         || CAST(CAST(rtrim(patient_age, 'Y') AS BIGINT) // 10 * 10 + 9 AS VARCHAR)
                    ELSE 'UNKNOWN' END AS patient_age_bucket,
               n_rows AS "rows", n_columns AS "columns", study_instance_uid, series_instance_uid, file_path
        FROM fx_headers""",
    "patients": """
        SELECT patient_id, max(CASE WHEN class = 'Lung Opacity' THEN 1 ELSE 0 END) AS label
        FROM fx_class_info GROUP BY patient_id""",
    "ranked": """
        SELECT patient_id, row_number() OVER (ORDER BY sha256('42:' || patient_id)) - 1 AS pos,
               count(*) OVER () AS n
        FROM patients WHERE patient_id IS NOT NULL""",
    "splits": """
        SELECT patient_id,
               CASE WHEN pos < floor(n * 0.70::DOUBLE) THEN 'train'
                    WHEN pos < floor(n * 0.70::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val'
                    ELSE 'test' END AS split
        FROM ranked""",
    "splits_two_way": """
        SELECT patient_id, CASE WHEN pos < floor(n * 0.8::DOUBLE) THEN 'train'
                                WHEN pos < floor(n * 0.8::DOUBLE) + floor(n * 0.2::DOUBLE) THEN 'val'
                                ELSE 'test' END AS split
        FROM ranked""",
    "gold": """
        SELECT p.patient_id, s.original_filename, p.label, m.split, s.modality, s.view_position, s.patient_sex,
               s.patient_age_bucket, s."rows", s."columns", s.file_path
        FROM silver s JOIN patients p ON s.original_filename = p.patient_id
             JOIN splits m ON m.patient_id = p.patient_id""",
    "readable": "SELECT * FROM silver WHERE modality IS NOT NULL AND file_path NOT LIKE '%5.dcm'",
    "read_gold": """
        SELECT g.* FROM gold g
        WHERE g.modality IS NOT NULL AND g.file_path NOT LIKE '%5.dcm'""",
    "completeness": " UNION ALL ".join(
        f"""SELECT 'schema_completeness' AS check_name, count(*) FILTER (WHERE "{f}" IS NULL) AS failing_rows,
               '{f}' AS field, count(*) FILTER (WHERE "{f}" IS NULL) = 0 AS passed, count(*) AS total_rows
        FROM silver"""
        for f in (
            "patient_id_hash",
            "original_filename",
            "modality",
            "view_position",
            "patient_sex",
            "rows",
            "columns",
        )
    ),
    "label_ids": "SELECT DISTINCT patient_id FROM fx_class_info",
    "integrity": """
        SELECT 'referential_integrity' AS check_name, count(*) FILTER (WHERE NOT present) AS failing_rows,
               'patient_id_to_image' AS field, count(*) FILTER (WHERE NOT present) = 0 AS passed,
               count(*) AS total_rows
        FROM (SELECT EXISTS (SELECT 1 FROM silver s WHERE s.original_filename IS NOT DISTINCT FROM l.patient_id)
                     AS present
              FROM label_ids l)""",
    "duplicates": """
        SELECT 'duplicate_detection' AS check_name, count(*) - count(DISTINCT content) AS failing_rows,
               'image_pixel_hash' AS field, count(*) = count(DISTINCT content) AS passed, count(*) AS total_rows
        FROM fx_files""",
    "age_range": """
        SELECT 'age_range_validity' AS check_name, count(*) FILTER (WHERE low > 120) AS failing_rows,
               'patient_age_bucket' AS field, count(*) FILTER (WHERE low > 120) = 0 AS passed,
               count(*) AS total_rows
        FROM (SELECT TRY_CAST(nullif(regexp_extract(patient_age_bucket, '^([0-9]+)-', 1), '') AS INTEGER) AS low
              FROM silver)""",
    "dq": """
        SELECT * FROM completeness UNION ALL SELECT * FROM integrity
        UNION ALL SELECT * FROM duplicates UNION ALL SELECT * FROM age_range""",
    "cases": """
        SELECT modality, view_position, label, count(*) AS case_count FROM gold GROUP BY ALL""",
    "people": """
        SELECT patient_sex, patient_age_bucket, label, count(*) AS case_count FROM gold GROUP BY ALL""",
    "judged": """
        SELECT kafka_offset, value,
               CASE WHEN NOT json_valid(value) THEN 'not_json'
                    WHEN json_type(value) <> 'OBJECT' THEN 'not_object'
                    WHEN NOT list_contains(json_keys(value), 'patient_id') THEN 'no_patient_id' END AS reason
        FROM fx_arrivals""",
    "manifest": """
        SELECT value ->> '$.patient_id' AS patient_id, value ->> '$.file_path' AS file_path,
               CAST(value ->> '$.ingestion_timestamp' AS DOUBLE) AS ingestion_timestamp, kafka_offset
        FROM judged WHERE reason IS NULL""",
    "predicted": """
        SELECT filename, scored_at, round(probability, 4) AS pneumonia_probability,
               CASE WHEN probability > 0.5 THEN 'Pneumonia' ELSE 'Normal/Other' END AS prediction,
               probability > 0.7 AS high_confidence_positive
        FROM fx_scores""",
    "alerts": """
        SELECT filename, pneumonia_probability, scored_at AS alert_timestamp
        FROM predicted WHERE high_confidence_positive""",
    "cells": """
        SELECT count(*) FILTER (WHERE label = 0 AND probability <= 0.5)::DOUBLE AS tn,
               count(*) FILTER (WHERE label = 0 AND probability > 0.5)::DOUBLE AS fp,
               count(*) FILTER (WHERE label = 1 AND probability <= 0.5)::DOUBLE AS fn,
               count(*) FILTER (WHERE label = 1 AND probability > 0.5)::DOUBLE AS tp
        FROM fx_scores""",
    "by_class": """
        SELECT 'Normal/Other' AS class, coalesce(tn / nullif(tn + fn, 0), 0) AS p,
               coalesce(tn / nullif(tn + fp, 0), 0) AS r, tn + fp AS s FROM cells
        UNION ALL
        SELECT 'Pneumonia', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), tp + fn
        FROM cells""",
    "with_f1": """
        SELECT class, p, r, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f, s FROM by_class""",
    "flat_pixels": """
        SELECT image_id, unnest(pixels) AS x, generate_subscripts(pixels, 1) - 1 AS pos FROM fx_pixels""",
    "bounds": """
        SELECT image_id, min(x) AS lo, max(x) AS hi FROM flat_pixels GROUP BY image_id""",
    "bytes": """
        SELECT f.image_id, CAST(f.pos AS INTEGER) AS pos,
               CASE WHEN hi > lo THEN CAST(floor((x - lo) / (hi - lo) * 255::FLOAT) AS INTEGER)
                    ELSE ((CAST(trunc(x) AS INTEGER) % 256) + 256) % 256 END AS v
        FROM flat_pixels f JOIN bounds b USING (image_id)""",
    "overlap": """
        SELECT i, o, greatest(0, least((i + 1) * 3, (o + 1) * 8) - greatest(i * 3, o * 8)) / 8.0::DOUBLE AS w
        FROM range(8) t(i), range(3) u(o)""",
    "overlap_12": """
        SELECT i, o, greatest(0, least((i + 1) * 12, (o + 1) * 8) - greatest(i * 12, o * 8)) / 8.0::DOUBLE AS w
        FROM range(8) t(i), range(12) u(o)""",
    "tent": """
        SELECT i, o, w / sum(w) OVER (PARTITION BY o) AS w
        FROM (SELECT i, o, greatest(0, 1 - abs(i + 0.5::DOUBLE - (o + 0.5::DOUBLE) * 8 / 3) * 3 / 8) AS w
              FROM range(8) t(i), range(3) u(o))""",
    "tent_half": """
        SELECT i, o, w / sum(w) OVER (PARTITION BY o) AS w
        FROM (SELECT i, o, greatest(0, 1 - abs(i + 0.5::DOUBLE - (o + 0.5::DOUBLE) * 2) / 2) AS w
              FROM range(8) t(i), range(4) u(o))""",
    "narrowed": """
        SELECT image_id, pos // 8 AS r, o AS c, floor(sum(v * w) + 0.5::DOUBLE) AS v
        FROM bytes JOIN tent_half ON i = pos % 8 GROUP BY image_id, pos // 8, o""",
    "halved": """
        SELECT image_id, o * 4 + c AS pos, floor(sum(v * w) + 0.5::DOUBLE) AS v
        FROM narrowed JOIN tent_half ON i = r GROUP BY image_id, o, c""",
    "upload_scores": """
        SELECT image_id, 1 / (1 + exp(-sum((v / 255.0::DOUBLE - m) / s
                                           * ((37 * (channel * 16 + pos)) % 11 - 5) / 8.0::DOUBLE))) AS p
        FROM halved, (VALUES (0, 0.485::DOUBLE, 0.229::DOUBLE), (1, 0.456::DOUBLE, 0.224::DOUBLE),
                             (2, 0.406::DOUBLE, 0.225::DOUBLE)) AS k(channel, m, s)
        WHERE image_id % 10 > 1 GROUP BY image_id""",
    "gap_rows": "SELECT * FROM fx_gaps WHERE label IS NOT NULL AND probability IS NOT NULL",
    "image_splits": """
        SELECT image_id, label, x_logit,
               CASE WHEN pos < floor(n * 0.70::DOUBLE) THEN 'train'
                    WHEN pos < floor(n * 0.70::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split
        FROM (SELECT image_id, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS label, count(*) OVER () AS n,
                     row_number() OVER (ORDER BY sha256('42:' || image_id)) - 1 AS pos
              FROM fx_pixels)
             JOIN (SELECT image_id, sum(x::DOUBLE * ((37 * pos) % 11 - 5) / 8.0::DOUBLE) AS x_logit
                   FROM flat_pixels GROUP BY image_id) USING (image_id)""",
    "image_weight": """
        SELECT count(*) FILTER (WHERE label = 0)::DOUBLE / count(*) FILTER (WHERE label = 1) AS pw, count(*) AS size
        FROM image_splits WHERE split = 'train'""",
    "unit_inputs": """
        SELECT image_id, j, tanh(sum(x::DOUBLE * (((pos * 3 + j) * 37) % 13 - 6) / 16.0::DOUBLE) + (j - 1) / 8.0::DOUBLE)
               AS h
        FROM flat_pixels, range(3) t(j) GROUP BY image_id, j""",
    "errors": """
        SELECT image_id, label, pw, z,
               CASE WHEN label = 1 THEN -pw / (1 + exp(z)) ELSE 1 / (1 + exp(-z)) END AS e
        FROM (SELECT image_id, sum(h * (j + 1) / 4.0::DOUBLE) + 0.0625::DOUBLE AS z FROM unit_inputs GROUP BY image_id)
             JOIN image_splits USING (image_id), image_weight
        WHERE split = 'train'""",
    "unit_errors": """
        SELECT image_id, j, h, e, e * (j + 1) / 4.0::DOUBLE * (1 - h * h) AS d
        FROM errors JOIN unit_inputs USING (image_id)""",
    "examples": "SELECT CAST(image_id AS VARCHAR) AS image_id, len(pixels) AS n_pixels FROM fx_pixels",
}

FINAL = {
    "bronze_class_info": "SELECT patient_id, class FROM fx_class_info",
    "distinct_patients": "SELECT count(*) AS n FROM label_ids",
    "binary_label": """
        SELECT patient_id, class, CASE WHEN class = 'Lung Opacity' THEN 1 ELSE 0 END AS label FROM fx_class_info""",
    "patient_labels": "SELECT patient_id, label FROM patients",
    "silver_headers": "SELECT * FROM silver",
    "age_buckets": "SELECT patient_age_bucket, count(*) AS n FROM silver GROUP BY ALL",
    "header_value_counts": """
        SELECT 'view_position' AS field, coalesce(view_position, 'MISSING') AS value, count(*) AS n
        FROM fx_headers GROUP BY ALL
        UNION ALL SELECT 'modality', coalesce(modality, 'MISSING'), count(*) FROM fx_headers GROUP BY ALL
        UNION ALL SELECT 'patient_sex', coalesce(patient_sex, 'MISSING'), count(*) FROM fx_headers GROUP BY ALL""",
    "header_sample_counts": """
        SELECT field, coalesce(value, 'MISSING') AS value, count(*) AS n
        FROM (SELECT unnest(['view_position', 'modality', 'patient_sex']) AS field,
                     unnest([view_position, modality, patient_sex]) AS value
              FROM (SELECT * FROM fx_headers ORDER BY file_name LIMIT 200))
        GROUP BY ALL""",
    "page_headers": """
        SELECT page_id,
               nullif(regexp_extract(html, '(?i)<html[^>]*\\slang="?([A-Za-z-]+)', 1), '') AS lang,
               nullif(regexp_extract(html, '(?i)charset="?([A-Za-z0-9_-]+)', 1), '') AS charset,
               nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title,
               nullif(regexp_extract(url, '^https?://([^/:?#]+)', 1), '') AS host
        FROM pages""",
    "parsed_headers": "SELECT * FROM silver WHERE modality IS NOT NULL AND file_path NOT LIKE '%5.dcm'",
    "parse_errors": """
        SELECT file_path, CASE WHEN modality IS NULL THEN 'no modality' ELSE 'n_rows is not a whole number' END
               AS error
        FROM silver WHERE modality IS NULL OR file_path LIKE '%5.dcm'""",
    "error_sample": """
        SELECT file_path, CASE WHEN modality IS NULL THEN 'no modality' ELSE 'n_rows is not a whole number' END
               AS error
        FROM silver WHERE modality IS NULL OR file_path LIKE '%5.dcm' ORDER BY file_path LIMIT 5""",
    "processed_paths": """
        SELECT file_path, 'processed/' || replace(regexp_extract(file_path, '[^/]*$'), '.dcm', '.png')
               AS processed_path
        FROM fx_headers""",
    "table_round_trip": """
        SELECT event_type, count(*) AS n, (SELECT count(*) FROM events) AS written FROM events GROUP BY event_type""",
    "csv_round_trip": "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer",
    "json_lines_round_trip": """
        SELECT job_name, row_count, notes FROM fx_audit
        UNION ALL SELECT job_name, row_count, notes FROM fx_audit WHERE row_count % 2 = 0""",
    "files_listed": """
        SELECT file_name, CAST(strlen(coalesce(content, '')) AS BIGINT) AS length
        FROM fx_files WHERE CAST(regexp_extract(file_name, '([0-9]+)', 1) AS BIGINT) % 7 <> 0""",
    "files_read": """
        SELECT file_name, md5(coalesce(content, '')) AS content_hash
        FROM fx_files WHERE CAST(regexp_extract(file_name, '([0-9]+)', 1) AS BIGINT) % 7 <> 0""",
    "published_files": """
        SELECT replace(file_name, '.dcm', '') AS patient_id, file_name, 1704067200.5::DOUBLE AS stamp
        FROM fx_headers""",
    "new_headers": """
        SELECT original_filename, modality, patient_age_bucket, "rows", regexp_extract(file_path, '[^/]*$') AS file_path,
               (SELECT count(*) FROM fx_headers) AS opened, 0::BIGINT AS opened_last, true AS read_a_part
        FROM readable""",
    "log_lines_read": "SELECT job_name, row_count, notes FROM fx_audit WHERE row_count % 5 <> 0",
    "packed_log": "SELECT job_name, row_count, notes, 1::BIGINT AS files FROM fx_audit",
    "log_lines_broken": """
        SELECT '{"job_name": "cut' AS line, count(*) AS n FROM fx_audit WHERE row_count % 5 = 0 HAVING count(*) > 0""",
    "clock_stamps": """
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS stamp FROM events""",
    "lake_case_counts": """
        SELECT modality, view_position, label, count(*) AS case_count FROM read_gold GROUP BY ALL""",
    "lake_audit": """
        SELECT '@labels' AS job_name, count(*) AS row_count, true AS has_schema FROM fx_class_info
        UNION ALL SELECT '@headers', count(*), true FROM readable
        UNION ALL SELECT '@quality', 10, false
        UNION ALL SELECT '@gold', count(*), true FROM read_gold
        UNION ALL
        SELECT '@summaries', (SELECT count(*) FROM (SELECT DISTINCT modality, view_position, label FROM read_gold))
               + (SELECT count(*) FROM (SELECT DISTINCT patient_sex, patient_age_bucket, label FROM read_gold))
               + 4, false""".replace("@labels", schemas.JOB_LABELS_INGEST)
    .replace("@headers", schemas.JOB_HEADERS_INGEST)
    .replace("@quality", schemas.JOB_QUALITY)
    .replace("@gold", schemas.JOB_MODEL_READY)
    .replace("@summaries", schemas.JOB_SUMMARIES),
    "training_facts": """
        SELECT 'training_set_size' AS metric, size::DOUBLE AS value FROM image_weight
        UNION ALL SELECT 'pos_weight', round(pw, 6) FROM image_weight""",
    "head_evaluation": """
        SELECT 'test_loss' AS metric,
               round(avg(pw * label * (ln(1 + exp(-abs(x_logit))) + greatest(-x_logit, 0))
                         + (1 - label) * (ln(1 + exp(-abs(x_logit))) + greatest(x_logit, 0))), 6) AS value
        FROM image_splits, image_weight WHERE split = 'test'
        UNION ALL
        SELECT 'test_auroc', round(sum(pos * (below + 0.5::DOUBLE * neg)) / (sum(pos) * sum(neg)), 6)
        FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY x_logit ROWS UNBOUNDED PRECEDING) - neg AS below
              FROM (SELECT x_logit, sum(label) AS pos, count(*) - sum(label) AS neg
                    FROM image_splits WHERE split = 'test' GROUP BY x_logit))""",
    "fit_gradient": """
        SELECT DISTINCT CAST(c * 64 + pos AS INTEGER) AS feature, 0.0::DOUBLE AS gradient
        FROM flat_pixels, range(3) t(c)""",
    "jdbc_key_parts": """
        SELECT CAST(part AS INTEGER) AS part, count(*) AS n
        FROM (SELECT coalesce(((k % 7) + 7) % 7, 0) AS part FROM fx_keys) GROUP BY part""",
    "patient_split_two_way": "SELECT patient_id, split FROM splits_two_way",
    "score_quality": """
        SELECT count(*) AS n_rows,
               count(*) FILTER (WHERE label IS NOT NULL AND probability IS NOT NULL) AS n_usable,
               count(*) FILTER (WHERE probability IS NULL) AS n_without_score,
               count(*) FILTER (WHERE label IS NULL) AS n_without_label
        FROM fx_gaps""",
    "confusion_matrix_gaps": """
        SELECT label, count(*) FILTER (WHERE probability <= 0.5) AS predicted_0,
               count(*) FILTER (WHERE probability > 0.5) AS predicted_1
        FROM gap_rows GROUP BY label""",
    "auroc_gaps": """
        SELECT round(sum(pos * (below + 0.5::DOUBLE * neg)) / (sum(pos) * sum(neg)), 6) AS auroc
        FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY p ROWS UNBOUNDED PRECEDING) - neg AS below
              FROM (SELECT probability AS p, sum(label) AS pos, count(*) - sum(label) AS neg
                    FROM gap_rows GROUP BY probability))""",
    "upload_alerts": """
        SELECT CAST(image_id AS VARCHAR) AS filename, round(p, 4) AS pneumonia_probability,
               '1704067200.500000' AS alert_timestamp
        FROM upload_scores WHERE p > 0.7""",
    "published_alerts": """
        SELECT CAST(image_id AS VARCHAR) AS filename, round(p, 4) AS pneumonia_probability,
               '1704067200.500000' AS alert_timestamp, run
        FROM upload_scores, (VALUES ('first'), ('second')) AS r(run) WHERE p > 0.7""",
    "published_predictions": """
        SELECT CAST(image_id AS VARCHAR) AS filename, round(p, 4) AS pneumonia_probability,
               CASE WHEN p > 0.5 THEN 'Pneumonia' ELSE 'Normal/Other' END AS prediction,
               p > 0.7 AS high_confidence_positive, run
        FROM upload_scores, (VALUES ('first'), ('second')) AS r(run)""",
    "dead_letters": """
        SELECT CAST(image_id AS VARCHAR) AS filename,
               CASE image_id % 10 WHEN 0 THEN 'not_an_image' ELSE 'unreadable' END AS rejected_because, run
        FROM fx_pixels, (VALUES ('first'), ('second')) AS r(run) WHERE image_id % 10 < 2""",
    "pixels_enlarge": """
        SELECT image_id, CAST(a.o AS INTEGER) AS r, CAST(b.o AS INTEGER) AS c, round(sum(x::DOUBLE * a.w * b.w), 5) AS v
        FROM flat_pixels JOIN overlap_12 a ON a.i = pos // 8 JOIN overlap_12 b ON b.i = pos % 8
        GROUP BY image_id, a.o, b.o""",
    "pixels_mixed": """
        SELECT image_id, CAST(a.o AS INTEGER) AS r, CAST(b.o AS INTEGER) AS c, round(sum(x::DOUBLE * a.w * b.w), 5) AS v
        FROM flat_pixels JOIN overlap a ON a.i = pos // 8 JOIN overlap_12 b ON b.i = pos % 8
        GROUP BY image_id, a.o, b.o""",
    "dq_schema_completeness": "SELECT * FROM completeness",
    "dq_referential_integrity": "SELECT * FROM integrity",
    "dq_duplicates": "SELECT * FROM duplicates",
    "dq_age_range": "SELECT * FROM age_range",
    "dq_results": "SELECT * FROM dq",
    "dq_merged": "SELECT * FROM dq",
    "incremental_case_counts": "SELECT * FROM cases",
    "incremental_demographics": "SELECT * FROM people",
    "dq_report": """
        SELECT CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status, check_name, field,
               '[' || status || '] ' || check_name || ' (' || field || '): ' || CAST(failing_rows AS VARCHAR)
               || '/' || CAST(total_rows AS VARCHAR) || ' failing' AS line
        FROM dq""",
    "dq_summary": """
        SELECT check_name, count(*) AS total_checks, round(avg(CAST(passed AS INTEGER)), 6) AS pass_rate
        FROM dq GROUP BY check_name""",
    "duplicate_pairs": """
        SELECT file_name, first_file_name
        FROM (SELECT file_name, min(file_name) OVER (PARTITION BY content) AS first_file_name FROM fx_files)
        WHERE file_name > first_file_name""",
    "patient_split": "SELECT patient_id, split FROM splits",
    "split_counts": """
        SELECT s.split, count(*) AS n_patients,
               (SELECT count(*) FROM gold g WHERE g.split = s.split) AS n_rows
        FROM splits s GROUP BY s.split""",
    "gold_model_ready": "SELECT * FROM gold",
    "split_train": "SELECT * FROM gold WHERE split = 'train'",
    "case_counts": "SELECT * FROM cases",
    "demographics": "SELECT * FROM people",
    "class_weight": """
        SELECT count(*) FILTER (WHERE label = 0) AS neg, count(*) FILTER (WHERE label = 1) AS pos,
               round(neg::DOUBLE / pos, 6) AS pos_weight
        FROM gold WHERE split = 'train'""",
    "training_examples": """
        SELECT original_filename, label, split, CAST(n_pixels AS INTEGER) AS n_pixels
        FROM gold JOIN examples ON original_filename = image_id""",
    "training_examples_bucketed": """
        SELECT original_filename, label, split, CAST(n_pixels AS INTEGER) AS n_pixels
        FROM gold JOIN examples ON original_filename = image_id""",
    "ops_metrics": """
        SELECT count(*) AS total_runs, count(DISTINCT job_name) AS unique_jobs,
               strftime(max(run_timestamp), '%Y-%m-%d %H:%M') AS latest_run
        FROM fx_audit""",
    "ops_run_history": "SELECT job_name, run_timestamp, row_count, notes FROM fx_audit",
    "dash_case_volumes": """
        SELECT view_position, CASE label WHEN 1 THEN 'Pneumonia' ELSE 'Normal/Other' END AS diagnosis, case_count
        FROM cases""",
    "dash_demographics": """
        SELECT * FROM people
        ORDER BY patient_sex NULLS FIRST, patient_age_bucket NULLS FIRST, label NULLS FIRST LIMIT 20""",
    "arrival_events": """
        SELECT '{"patient_id":"' || replace(regexp_extract(file_path, '[^/]*$'), '.dcm', '') || '","file_path":"'
               || file_path || '","ingestion_timestamp":1704067200.500000}' AS value
        FROM fx_headers""",
    "arrival_manifest": "SELECT * FROM manifest",
    "arrival_manifest_stream": "SELECT * FROM manifest",
    "arrival_unknown_fields": """
        SELECT *, 's' || CAST(kafka_offset % 7 AS VARCHAR) AS site, kafka_offset % 5 AS tag, NULL::VARCHAR AS none
        FROM manifest""",
    "arrival_manifest_replayed": "SELECT * FROM manifest",
    "arrival_rejects": "SELECT reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY reason",
    "predictions": """
        SELECT filename, pneumonia_probability, prediction, high_confidence_positive FROM predicted""",
    "clinical_alerts": "SELECT * FROM alerts",
    "clinical_alerts_stream": "SELECT * FROM alerts",
    "recent_alerts": """
        SELECT * FROM alerts ORDER BY alert_timestamp DESC, filename, pneumonia_probability DESC LIMIT 20""",
    "topic_alerts": """
        SELECT * FROM alerts ORDER BY alert_timestamp DESC, filename, pneumonia_probability DESC LIMIT 20""",
    "standing_alerts": """
        SELECT * FROM alerts ORDER BY alert_timestamp DESC, filename, pneumonia_probability DESC LIMIT 20""",
    "alert_banners": """
        SELECT printf('⚠️ **%s** — %.1f%% pneumonia probability at %s', filename, pneumonia_probability * 100,
                      strftime(alert_timestamp, '%Y-%m-%d %H:%M:%S')) AS text
        FROM (SELECT * FROM alerts
              ORDER BY alert_timestamp DESC, filename, pneumonia_probability DESC LIMIT 5)""",
    "reject_non_image": """
        SELECT page_id, page_id % 4 <> 0 AND page_id % 3 = 2 AS accepted,
               CASE WHEN page_id % 4 = 0 THEN 'not_an_image' WHEN page_id % 3 < 2 THEN 'unreadable' END
                    AS rejected_because
        FROM pages""",
    "confusion_matrix": """
        SELECT label, count(*) FILTER (WHERE probability <= 0.5) AS predicted_0,
               count(*) FILTER (WHERE probability > 0.5) AS predicted_1
        FROM fx_scores GROUP BY label""",
    "classification_report": """
        SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
               CAST(s AS BIGINT) AS support FROM with_f1
        UNION ALL
        SELECT 'accuracy', NULL, NULL, round((tn + tp) / (tn + fp + fn + tp), 6),
               CAST(tn + fp + fn + tp AS BIGINT) FROM cells
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(s) AS BIGINT)
        FROM with_f1
        UNION ALL
        SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6),
               round(sum(f * s) / sum(s), 6), CAST(sum(s) AS BIGINT)
        FROM with_f1""",
    "auroc": """
        SELECT round(sum(pos * (below + 0.5::DOUBLE * neg)) / (sum(pos) * sum(neg)), 6) AS auroc
        FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY p ROWS UNBOUNDED PRECEDING) - neg AS below
              FROM (SELECT probability AS p, sum(label) AS pos, count(*) - sum(label) AS neg
                    FROM fx_scores GROUP BY probability))""",
    "weighted_log_loss": """
        SELECT round(avg((2383 / 617::DOUBLE) * label * (ln(1 + exp(-abs(logit))) + greatest(-logit, 0))
                         + (1 - label) * (ln(1 + exp(-abs(logit))) + greatest(logit, 0))), 6) AS loss
        FROM fx_logits""",
    "sigmoid_scores": "SELECT row_id, round(1 / (1 + exp(-logit)), 6) AS probability FROM fx_logits",
    "best_epoch": """
        SELECT run_name, val_auroc AS best, step AS best_step FROM fx_run_metrics WHERE val_auroc IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY run_name ORDER BY val_auroc DESC, step) = 1""",
    "pixels_minmax": "SELECT * FROM bytes",
    "pixels_resize": """
        SELECT image_id, CAST(a.o AS INTEGER) AS r, CAST(b.o AS INTEGER) AS c, round(sum(x::DOUBLE * a.w * b.w), 5) AS v
        FROM flat_pixels JOIN overlap a ON a.i = pos // 8 JOIN overlap b ON b.i = pos % 8
        GROUP BY image_id, a.o, b.o""",
    "pixels_bilinear": """
        SELECT image_id, CAST(a.o AS INTEGER) AS r, CAST(b.o AS INTEGER) AS c, round(sum(x::DOUBLE * a.w * b.w), 5) AS v
        FROM flat_pixels JOIN tent a ON a.i = pos // 8 JOIN tent b ON b.i = pos % 8
        GROUP BY image_id, a.o, b.o""",
    "images_processed": """
        SELECT image_id, CAST(a.o AS INTEGER) AS r, CAST(b.o AS INTEGER) AS c,
               CAST(round_even(sum(v * a.w * b.w), 0) AS INTEGER) AS v
        FROM bytes JOIN overlap a ON a.i = pos // 8 JOIN overlap b ON b.i = pos % 8
        GROUP BY image_id, a.o, b.o""",
    "pixels_standardize": """
        SELECT image_id, channel, pos, round((v / 255.0::DOUBLE - m) / s, 5) AS v
        FROM bytes, (VALUES (0, 0.485::DOUBLE, 0.229::DOUBLE), (1, 0.456::DOUBLE, 0.224::DOUBLE),
                            (2, 0.406::DOUBLE, 0.225::DOUBLE)) AS k(channel, m, s)""",
    "upload_features": """
        SELECT CAST(image_id AS VARCHAR) AS filename, channel, CAST(pos AS INTEGER) AS pos,
               round((v / 255.0::DOUBLE - m) / s, 5) AS v
        FROM halved, (VALUES (0, 0.485::DOUBLE, 0.229::DOUBLE), (1, 0.456::DOUBLE, 0.224::DOUBLE),
                             (2, 0.406::DOUBLE, 0.225::DOUBLE)) AS k(channel, m, s)""",
    "step_gradient": """
        SELECT 'loss' AS kind, 0::BIGINT AS position,
               round(avg(CASE WHEN label = 1 THEN pw * (ln(1 + exp(-abs(z))) + greatest(-z, 0))
                              ELSE ln(1 + exp(-abs(z))) + greatest(z, 0) END), 6) + 0.0::DOUBLE AS value
        FROM errors
        UNION ALL
        SELECT 'slope', CAST(pos * 3 + j AS BIGINT), round(sum(x::DOUBLE * d) / (SELECT count(*) FROM errors), 6) + 0.0::DOUBLE
        FROM unit_errors JOIN flat_pixels USING (image_id) GROUP BY pos, j
        UNION ALL
        SELECT 'slope', CAST(192 + j AS BIGINT), round(avg(d), 6) + 0.0::DOUBLE FROM unit_errors GROUP BY j
        UNION ALL
        SELECT 'slope', CAST(195 + j AS BIGINT), round(avg(e * h), 6) + 0.0::DOUBLE FROM unit_errors GROUP BY j
        UNION ALL
        SELECT 'slope', 198::BIGINT, round(avg(e), 6) + 0.0::DOUBLE FROM errors""",
    "epoch_facts": """
        SELECT run_name, step, metric, value
        FROM (SELECT 'phase1_frozen_backbone' AS run_name, step, 0.001::DOUBLE AS rate FROM range(3) t(step)
              UNION ALL
              SELECT 'phase2_fine_tune', step, round(0.0001::DOUBLE * (1 + cos(pi() * step / 8)) / 2, 9)
              FROM range(8) t(step)),
             (SELECT size FROM image_weight),
             LATERAL (VALUES ('learning_rate', rate), ('train_rows', size::DOUBLE)) AS v(metric, value)""",
    "batch_scores": """
        SELECT image_id, CASE WHEN image_id % 9 <> 0
                              THEN round(1 / (1 + exp(-sum(x::DOUBLE * ((37 * pos) % 11 - 5) / 8.0::DOUBLE))), 6) END
                         AS probability
        FROM flat_pixels GROUP BY image_id""",
}


def _needed(text: str, found: list[str]) -> list[str]:
    """Names of the views and parts a text uses, in definition order."""
    for name in [*VIEWS, *PARTS]:
        if name not in found and re.search(rf"\b{name}\b", text) and not text.startswith(f"--{name}"):
            body = duckdb_text(name) if name in VIEWS else PARTS[name]
            _needed(f"--{name}\n{body}", found)
            found.append(name)
    return found


def oracle(name: str) -> str:
    parts = [
        f"{part} AS ({duckdb_text(part) if part in VIEWS else PARTS[part]})"
        for part in _needed(FINAL[name], [])
    ]
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return head + FINAL[name]


ORACLES = {name: oracle(name) for name in FINAL}
