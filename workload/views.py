"""Archive-shaped views of the driver's tables.

Every view is one SQL text that Spark and DuckDB both accept, over whole tables.
Missing files, nulls and differences are put in by CASE expressions, so no row
of a table is left out. ``{name}`` stands for a driver table or another view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from stocktake.functions.skew import apart

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    "observation": """
        SELECT o_orderkey AS obs_id, CAST(o_orderkey AS VARCHAR(20)) AS observation_id,
               c_mktsegment AS collection,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN 'NULL'
                    ELSE o_orderpriority END AS instrument_name,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'calibration'
                    ELSE 'science' END AS intent,
               CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderdate END AS meta_release,
               o_orderdate AS max_last_modified
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "plane": """
        SELECT l_orderkey * 10 + l_linenumber AS plane_id, l_orderkey AS obs_id,
               CASE MIN(CASE WHEN l_linestatus = 'O' THEN 1 WHEN l_linenumber = 7 THEN NULL ELSE 2 END)
                    WHEN 1 THEN 'image' WHEN 2 THEN 'spectrum' END AS data_product_type,
               CASE WHEN MAX(l_quantity) >= 49 THEN 'junk' WHEN MAX(l_quantity) < 25 THEN NULL
                    ELSE 'ok' END AS quality_flag,
               MAX(l_shipdate) AS max_last_modified
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    # A fifth of the files hang on the first plane of their order, so that other planes
    # have none and some files belong to a plane that does not exist.
    "artifact": """
        SELECT l_orderkey * 10 + CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE l_linenumber END AS plane_id,
               concat(p_brand, '/', CAST(l_partkey AS VARCHAR(20)), '/', CAST(l_suppkey AS VARCHAR(20)),
                      '/', CAST(CAST(l_quantity AS INT) AS VARCHAR(20))) AS uri,
               CASE p_type WHEN 'ECONOMY' THEN 'science' WHEN 'STANDARD' THEN 'preview'
                    WHEN 'PROMO' THEN 'thumbnail' WHEN 'SMALL' THEN 'calibration'
                    WHEN 'MEDIUM' THEN 'this'
                    ELSE CASE l_suppkey % 13 WHEN 0 THEN 'auxiliary' WHEN 1 THEN 'bias' WHEN 2 THEN 'coderived'
                         WHEN 3 THEN 'dark' WHEN 4 THEN 'documentation' WHEN 5 THEN 'error' WHEN 6 THEN 'flat'
                         WHEN 7 THEN 'info' WHEN 8 THEN 'noise' WHEN 9 THEN 'preview-image'
                         WHEN 10 THEN 'preview-plot' WHEN 11 THEN 'weight' ELSE 'sketch' END
                    END AS product_type,
               md5(concat(CAST(l_partkey AS VARCHAR(20)), '-', CAST(l_suppkey AS VARCHAR(20))))
                   AS content_checksum,
               CASE WHEN l_linenumber = 6 THEN NULL
                    ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS content_length,
               p_type AS content_type, l_shipdate AS last_modified
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    # Some files are described again: with the same time and other content, without a time,
    # and by the collection of another source.
    "catalog": """
        SELECT CASE WHEN copy = 3 THEN CASE source WHEN 'src1' THEN 'src0' ELSE 'src1' END ELSE source END AS collection,
               concat('ns', source, '/', CASE WHEN doc_id % 11 = 0 THEN 'moved/'
                                              WHEN doc_id % 13 = 0 THEN 'stray/' ELSE '' END,
                      CAST(doc_id AS VARCHAR(20))) AS uri,
               CASE WHEN doc_id % 23 = 0 THEN NULL WHEN copy = 1 THEN md5(concat(text, 'y')) ELSE md5(text) END
                   AS content_checksum,
               n_chars AS content_length, lang AS content_type,
               CASE WHEN copy = 2 THEN NULL ELSE DATE '2024-01-01' + CAST(doc_id % 365 AS INT) END AS last_modified
        FROM (SELECT *, 0 AS copy FROM {documents}
              UNION ALL SELECT *, 1 FROM {documents} WHERE doc_id % 8 = 1
              UNION ALL SELECT *, 2 FROM {documents} WHERE doc_id % 8 = 2
              UNION ALL SELECT *, 3 FROM {documents} WHERE doc_id % 8 = 3) c""",
    "inventory": """
        SELECT source AS collection,
               concat('ns', source, '/', CASE WHEN doc_id % 13 = 0 THEN 'stray/' ELSE '' END,
                      CAST(doc_id AS VARCHAR(20))) AS uri,
               CASE WHEN doc_id % 7 = 0 OR copy = 1 THEN md5(concat(text, 'x')) ELSE md5(text) END
                   AS content_checksum,
               CASE WHEN doc_id % 5 = 0 THEN n_chars + 1 ELSE n_chars END AS content_length,
               CASE WHEN doc_id % 3 = 0 THEN 'xx' ELSE lang END AS content_type,
               CASE WHEN copy = 2 THEN NULL ELSE DATE '2024-02-01' + CAST(doc_id % 365 AS INT) END AS last_modified
        FROM (SELECT *, 0 AS copy FROM {documents}
              UNION ALL SELECT *, 1 FROM {documents} WHERE doc_id % 6 = 1
              UNION ALL SELECT *, 2 FROM {documents} WHERE doc_id % 6 = 2) c""",
    # Site beta and gamma keep some files outside every namespace.
    "site_inventory": """
        SELECT 'alpha' AS site, uri FROM {inventory}
        UNION ALL
        SELECT 'beta', CASE WHEN content_length % 10 = 0 THEN concat('cache/', uri) ELSE uri END
        FROM {inventory}
        UNION ALL
        SELECT 'gamma', CASE WHEN content_type = 'xx' THEN concat('cache/', uri) ELSE uri END
        FROM {inventory}""",
    # Counts with the time they took, as services report them.
    "timed_counts": """
        SELECT '2024-01-15' AS datestamp, namespace, site, num AS count,
               CASE WHEN num % 3 = 0 THEN NULL ELSE num / CAST(8 AS DOUBLE) END AS duration
        FROM (SELECT concat('ns', source) AS namespace, lang AS site, COUNT(*) AS num FROM {documents} GROUP BY source, lang) t""",
    # One namespace per source, a deeper one inside it, and one no file is in.
    "namespaces": """
        SELECT DISTINCT concat('ns', source) AS namespace FROM {documents}
        UNION SELECT DISTINCT concat('ns', source, '/stray') FROM {documents}
        UNION SELECT DISTINCT concat('none', source) FROM {documents}""",
    # Sources 0-1 and 2-3-4 share namespaces; every source has a namespace inside its own.
    "mappings": """
        SELECT DISTINCT source AS collection, concat('ns', source) AS si_namespace FROM {documents}
        UNION
        SELECT DISTINCT source, concat('ns', source, '/stray') FROM {documents}
        UNION
        SELECT DISTINCT source, concat('ns', CASE source WHEN 'src0' THEN 'src1' WHEN 'src2' THEN 'src3'
                                             WHEN 'src3' THEN 'src4' ELSE source END)
        FROM {documents}""",
    # Collections and namespaces in chains of eight namespaces, then two on their own.
    "mapping_graph": """
        SELECT concat('C', CAST(c_custkey AS VARCHAR(20))) AS collection,
               concat('N', CAST((c_custkey - c_custkey % 3) / 3 + shift AS INT)) AS si_namespace
        FROM (SELECT c_custkey, 0 AS shift FROM {customer}
              UNION ALL
              SELECT c_custkey,
                     CASE WHEN c_custkey % 3 = 0 AND c_custkey % 30 < 21 THEN 1 ELSE 0 END
              FROM {customer}) t""",
    # Each collection uses many brands, and some single parts of a brand as namespaces of their own.
    # A part belongs to the market segment of the nation with its number.
    "part_segment": """
        SELECT p_partkey, p_brand, CASE p_partkey % 5 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'FURNITURE'
               WHEN 3 THEN 'HOUSEHOLD' ELSE 'MACHINERY' END AS segment
        FROM {part}""",
    "brand_mappings": """
        SELECT DISTINCT segment AS collection, p_brand AS si_namespace FROM {part_segment}
        UNION
        SELECT segment, concat(p_brand, '/', CAST(p_partkey AS VARCHAR(20))) FROM {part_segment}""",
    # The archive's own files under the same namespaces: some missing, some changed, some stray.
    "archive_inventory": """
        SELECT uri, CASE WHEN content_length % 7 = 0 THEN md5(concat(content_checksum, 'x')) ELSE content_checksum END
                   AS content_checksum,
               CASE WHEN content_length % 5 = 0 THEN content_length + 1 ELSE content_length END AS content_length,
               CASE WHEN content_length % 3 = 0 THEN 'xx' ELSE content_type END AS content_type, last_modified
        FROM {artifact} WHERE content_length IS NULL OR content_length % 4 <> 0
        UNION ALL
        SELECT concat(uri, '.old'), content_checksum, content_length, content_type, last_modified
        FROM {artifact} WHERE content_length % 11 = 0""",
    # One brand and a part inside it in each market segment; two segments share a brand.
    "archive_mappings": """
        SELECT DISTINCT segment AS collection, p_brand AS si_namespace FROM {part_segment}
        WHERE p_brand = CASE segment WHEN 'AUTOMOBILE' THEN 'Brand#1' WHEN 'BUILDING' THEN 'Brand#1'
                             WHEN 'FURNITURE' THEN 'Brand#3' WHEN 'HOUSEHOLD' THEN 'Brand#4' ELSE 'Brand#5' END
        UNION
        SELECT segment, concat(p_brand, '/', CAST(p_partkey AS VARCHAR(20))) FROM {part_segment}
        WHERE p_brand = CASE segment WHEN 'BUILDING' THEN 'Brand#1' WHEN 'FURNITURE' THEN 'Brand#3' END""",
    # Fields of the archive's observation table in its own spelling.
    "source_observation": """
        SELECT obs_id AS "obsID", observation_id AS "observationID", collection, instrument_name, intent,
               meta_release AS "metaRelease", max_last_modified AS "maxLastModified",
               CASE WHEN obs_id % 7 = 0 THEN NULL ELSE 1 END AS "accMetaChecksum"
        FROM {observation}""",
    "collections": """
        SELECT concat('C', CAST(c_custkey AS VARCHAR(20))) AS collection, c_acctbal > 0 AS in_si,
               CASE WHEN c_nationkey = 7 THEN NULL
                    ELSE concat('S', CAST(c_nationkey AS VARCHAR(20))) END AS ams_site
        FROM {customer}""",
    "ams_sites": """
        SELECT concat(CASE WHEN n_regionkey = 4 THEN 'X' ELSE 'S' END,
                      CAST(n_nationkey AS VARCHAR(20))) AS site_name,
               concat('/archive/', n_name) AS site_url
        FROM {nation}""",
    "requested": """
        SELECT concat('C', CAST(o_custkey AS VARCHAR(20))) AS collection
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        WHERE c_acctbal > 0 AND c_nationkey <> 7 AND c_nationkey <> 3 AND o_orderstatus = 'F'
        GROUP BY o_custkey HAVING COUNT(*) > 3""",
    "harvest_skip": """
        SELECT event_id AS skip_id,
               CASE WHEN event_id % 7 = 0 THEN 'Plane' ELSE 'Observation' END AS cname,
               concat(CASE WHEN user_id % 2 = 0 THEN 'src/SKY/' ELSE 'src/OTHER/' END,
                      CAST(user_id AS VARCHAR(20))) AS source,
               CASE WHEN event_id % 23 = 0 THEN NULL ELSE ts END AS try_after,
               CASE WHEN event_type = 'error' THEN concat('could not read ', props, ' of the record harvested for ', CAST(event_id AS VARCHAR(20)))
               END AS error_message
        FROM {events}""",
    "site_observation": """
        SELECT 'origin' AS site, collection FROM {observation}
        UNION ALL
        SELECT 'mirror', CASE WHEN intent IS NULL THEN 'PENDING' ELSE collection END FROM {observation}
        UNION ALL
        SELECT 'public', CASE WHEN meta_release IS NULL THEN 'PENDING' ELSE collection END
        FROM {observation}""",
    # Many directories; uploads of one time, without a time, and listed twice.
    "upload_listing": """
        SELECT concat('d', CAST(user_id AS VARCHAR(20)), 'x', CAST(event_id % 12 AS VARCHAR(20))) AS dir,
               concat(CASE event_type WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'my Slides v'
                                                              ELSE 'Poster' END ELSE 'paper' END,
                      CASE WHEN event_id % 31 = 0 THEN concat('d', CAST(user_id AS VARCHAR(20)), '.pdf')
                           ELSE '' END,
                      CASE WHEN event_id % 37 = 0 THEN 'a b' ELSE '' END,
                      CAST(event_id AS VARCHAR(20)),
                      CASE event_type WHEN 'purchase' THEN '.tar.gz' WHEN 'click' THEN '.tex'
                           WHEN 'view' THEN '.png' WHEN 'error' THEN
                           CASE WHEN event_id % 3 = 0 THEN '.mp4' ELSE '.Log' END ELSE '.pdf' END) AS name,
               CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 5 = 0 THEN date_trunc('month', ts) ELSE ts END AS modified,
               CASE WHEN event_id % 17 = 0 THEN 'service' ELSE 'author' END AS owner
        FROM (SELECT * FROM {events} UNION ALL SELECT * FROM {events} WHERE event_id % 21 = 0) c""",
    "source_manifest": """
        SELECT concat('d', CAST(user_id AS VARCHAR(20)), '/', CAST(event_id % 12 AS VARCHAR(20))) AS dir,
               concat(CAST(event_id AS VARCHAR(20)),
                      CASE event_type WHEN 'purchase' THEN '.tar.gz' WHEN 'click' THEN '.zip'
                           ELSE '.tex' END) AS name,
               md5(props) AS checksum
        FROM {events}""",
    # Renamed files and files in directories the source does not have.
    "target_manifest": """
        SELECT concat(CASE WHEN event_id % 14 = 0 THEN 'e' ELSE 'd' END, CAST(user_id AS VARCHAR(20)), '/',
                      CAST(event_id % 12 AS VARCHAR(20))) AS dir,
               concat(CASE WHEN event_id % 9 = 0 THEN 'old_' ELSE '' END, CAST(event_id AS VARCHAR(20)),
                      CASE event_type WHEN 'purchase' THEN '.tar.gz' WHEN 'click' THEN '.zip'
                           ELSE '.tex' END) AS name,
               md5(CASE WHEN event_id % 6 = 0 THEN concat(props, 'x') ELSE props END) AS checksum
        FROM {events}""",
    "contributions": """
        SELECT concat(substring('BCFIPTXZ', CAST(c_custkey % 8 AS INT) + 1, 1),
                      CAST(c_custkey AS VARCHAR(20))) AS name
        FROM {customer}""",
    "contents": """
        SELECT concat('p. ', CAST(o_orderkey AS VARCHAR(20)), ': ',
                      CASE WHEN o_custkey % 5 = 0 THEN 'withdrawn'
                           ELSE concat(substring('BCFIPTXZ', CAST(o_custkey % 8 AS INT) + 1, 1),
                                       CAST(o_custkey AS VARCHAR(20))) END, '_final') AS line
        FROM {orders}""",
}

_REF = re.compile(r"\{(\w+)\}")


def _names(text: str) -> list[str]:
    return list(dict.fromkeys(_REF.findall(text)))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view or driver table as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name].replace('"', "`")
    # Tables that meet in a view are not broadcast by the size of their files.
    side = apart if " JOIN " in text else lambda table: table
    return spark.sql(text, **{n: side(view(spark, sf_dir, n)) for n in _names(text)})


def with_views(query: str) -> str:
    """DuckDB text of ``query``: the views it names in braces become CTEs."""
    needed: list[str] = []

    def need(name):
        if name in VIEWS and name not in needed:
            for inner in _names(VIEWS[name]):
                need(inner)
            needed.append(name)

    for name in _names(query):
        need(name)
    ctes = [f"{n} AS MATERIALIZED ({_REF.sub(r'\1', VIEWS[n])})" for n in needed]
    body = _REF.sub(r"\1", query)
    recursive = body.lstrip().upper().startswith("RECURSIVE ")
    if recursive:
        return f"WITH RECURSIVE {', '.join([*ctes, body.lstrip()[len('RECURSIVE '):]])}"
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {', '.join([*ctes, body.lstrip()[len('WITH '):]])}"
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
