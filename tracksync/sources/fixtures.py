"""Stand-in views over the driver tables (see FIXTURES.md section 3).

Each view is one SQL text that runs unchanged on Spark and on DuckDB.  The
texts reference the driver tables as ``{orders}``-style placeholders: Spark
fills them with DataFrames (``spark.sql(text, orders=df)``), the DuckDB oracle
fills them with the view names.  Literal JSON braces are doubled for that
reason.  Modulo expressions in these texts *plant* cases (missing items, NULL
values, repeated keys); every base row still flows into the views, nothing is
sampled to make a check cheaper.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SeedDefaults, SyncConfig

# Neutral settings of the stand-in tables.
FIXTURE_CONFIG = SyncConfig(
    entity_type="WorkPackage", dossier_type=8, request_type=9, operator_id=1, seed_exclude_prefix="33",
    seed=SeedDefaults(type_id=8, project_id=44, status_id=18, priority_id=8, author_id=4, lock_version=2),
    history_state_key="estado", history_date_key="fecha",
    partner_label="PARTNER", partner_field_id=71, request_suffix=" PETICIONES", suffix_word="PETICIONES",
    ref_field_id=90, relation_type="relates", state_field_id=136, due_label="due_date",
    float_format="float", recode_field_id=131, recode_map=(("SI", "33"), ("NO", "34")),
    class_field_id=139, probe_a_field_id=85, probe_b_field_id=10,
    code_only_a="57", code_only_b="56", code_none="93", code_both="58", pole_yes="33", pole_no="34",
    capacity_labels=(("installed", "installed_m"), ("used", "used_m"), ("cable_count", "mesh_m"), ("has_pole", "has_pole")),
    tri_true="SI", tri_false="NO", tri_null="DESCONOCIDO",
    registry_scalars=(("installed_m", "installed"), ("used_m", "used"), ("current_state", "state"), ("miga_code", "miga"),
                      ("owner_name", "owner"), ("nation_code", "nation"), ("balance", "balance"),
                      ("balance_whole", "balance_whole"), ("balance_micro", "balance_micro"), ("serial", "serial"),
                      ("segment_code", "segment_code"), ("even_flag", "even"), ("route. no", "route_no"), ("remark", "remark")),
    registry_tristate=("hidden_flag", "hidden"), registry_doc_count_label="final_docs",
    registry_area_labels=("area", "zone"),
    registry_class_labels=(("cr", "n_cr"), ("arq", "n_arq"), ("arm", "n_arm"), ("pole", "n_pole")),
    bucket_labels=(("n_chamber_idle", "n_cr_uso0"), ("n_duct", "n_isolated"), ("n_rest", "n_pedestal")),
)

# The fixture definitions of FIXTURES.md section 3.
FX_SQL: dict[str, str] = {
    "fx_projects": """
SELECT CAST(n_nationkey AS INT) AS id, n_name AS name, CAST(NULL AS INT) AS parent_id FROM {nation}
UNION ALL SELECT CAST(100 + n_nationkey AS INT), n_name || CASE WHEN n_nationkey % 2 = 0 THEN ' PETICIONES' ELSE ' Peticiones ' END, CAST(n_nationkey AS INT) FROM {nation}
""",
    "fx_items": """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 9 ELSE 8 END AS type_id,
 CASE WHEN o_orderkey % 3 = 0 THEN 'REQ-' || CAST(o_orderkey AS STRING) ELSE CAST(o_orderkey AS STRING) END AS subject,
 CAST(CASE WHEN o_orderkey % 3 = 0 THEN 100 ELSE 0 END + o_custkey % 25 AS INT) AS project_id FROM {orders} WHERE o_orderkey % 11 <> 0
""",
    "fx_fields": """
SELECT * FROM (VALUES (1,'click','date'),(2,'view','date'),(3,'purchase','date'),(4,'signup','date'),(5,'error','date'),
 (10,'proposed','date'),(85,'pending','date'),(139,'replan_kind','list'),(40,'installed_m','float'),(41,'used_m','float'),
 (71,'PARTNER','list'),(87,'due_date','date'),(90,'ref_id','string'),(131,'hidden_flag','list'),(136,'current_state','string'),(59,'has_pole','list'),
 (200,'mesh_m','float'),(201,'miga_code','string'),(202,'area','list'),(203,'zone','list'),(204,'final_docs','int'),(205,'n_cr','int'),(206,'n_arq','int'),(207,'n_arm','int'),
 (208,'n_pole','int'),(209,'n_cr_uso0','int'),(210,'n_isolated','int'),(211,'n_pedestal','int'),(212,'owner_name','string'),(213,'nation_code','int'),(214,'balance','float'),
 (215,'balance_whole','float'),(216,'balance_micro','float'),(217,'serial','string'),(218,'segment_code','string'),(219,'even_flag','string'),(220,'route. no','int'),(221,'remark','string')) AS t(id, name, field_format)
""",
    "fx_values": """
SELECT customized_id * 1000 + custom_field_id AS id, 'WorkPackage' AS customized_type, customized_id, custom_field_id, value FROM (
 SELECT event_id AS customized_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS custom_field_id, CAST(CAST(ts AS DATE) AS STRING) AS value FROM {events}
 UNION ALL SELECT event_id, 136, event_type FROM {events} WHERE event_id % 2 = 0
 UNION ALL SELECT event_id, 87, CAST(NULL AS STRING) FROM {events} WHERE event_id % 4 = 0
 UNION ALL SELECT o_orderkey, 71, CASE o_orderkey % 5 WHEN 1 THEN '' WHEN 2 THEN CAST(NULL AS STRING) ELSE 'NATION_' || CAST(o_custkey % 25 AS STRING) END FROM {orders} WHERE o_orderkey % 5 <> 0
 UNION ALL SELECT o_orderkey, 90, CASE WHEN o_orderkey % 2 = 0 THEN CAST(NULL AS STRING) ELSE CAST(o_orderkey + 1 AS STRING) END FROM {orders} WHERE o_orderkey % 3 = 0
 UNION ALL SELECT o_orderkey, 40, CASE WHEN o_orderkey % 4 = 1 THEN REPLACE(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING), '.', ',') ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END FROM {orders}
 UNION ALL SELECT o_orderkey, 131, CASE o_orderstatus WHEN 'F' THEN 'SI' WHEN 'O' THEN 'NO' ELSE 'DESCONOCIDO' END FROM {orders}
 UNION ALL SELECT o_orderkey, 10, CASE WHEN o_orderkey % 4 = 0 THEN CAST(NULL AS STRING) ELSE '2024-01-01' END FROM {orders} WHERE o_orderkey % 2 = 0
 UNION ALL SELECT o_orderkey, 85, '2024-02-02' FROM {orders} WHERE o_orderkey % 5 < 2
 UNION ALL SELECT o_orderkey, 139, CAST(NULL AS STRING) FROM {orders} WHERE o_orderkey % 7 < 4) u
UNION ALL SELECT -1 - c_custkey, 'Project', c_custkey, 40, '7,5' FROM {customer}
""",
    "fx_relations": """
SELECT o_orderkey AS from_id, o_orderkey + 1 AS to_id, 'relates' AS relation_type FROM {orders} WHERE o_orderkey % 9 = 3
UNION ALL SELECT o_orderkey + 1, o_orderkey, 'relates' FROM {orders} WHERE o_orderkey % 9 = 6
""",
    "fx_state_days": """
SELECT * FROM (VALUES ('click',10),('view',20),('purchase',-3),('signup',CAST(NULL AS INT))) AS t(state, add_days)
""",
    "fx_history": """
SELECT CAST(event_id AS STRING) AS num, CASE event_id % 6 WHEN 0 THEN CAST(NULL AS STRING) WHEN 1 THEN '[]' ELSE
 '[{{"estado":"' || event_type || '","fecha":"' || CAST(DATE_TRUNC('second', ts) AS STRING) || '"}},{{"estado":"error","fecha":"2023-05-06 07:08:09"}},{{"estado":"error","fecha":' || CASE WHEN event_id % 6 = 2 THEN 'null' ELSE '"2022-01-01 00:00:00"' END || '}},{{"estado":"archived","fecha":"2022-01-01 00:00:00"}}]' END AS hist FROM {events}
""",
    "fx_registry": """
SELECT c_custkey AS id, CAST(CASE WHEN c_custkey % 10 = 7 THEN c_custkey - 6 ELSE c_custkey END AS STRING) AS num, CAST(c_custkey % 3 AS INT) AS operator_id, CAST(c_acctbal AS DECIMAL(12,2)) AS installed,
 CAST(c_custkey % 7 AS INT) AS used, CASE c_custkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END AS hidden, c_mktsegment AS state, 'M' || CAST(c_nationkey AS STRING) AS miga,
 c_name AS owner, CAST(c_nationkey AS INT) AS nation, c_acctbal AS balance, ROUND(c_acctbal, 0) AS balance_whole, c_acctbal * 1000000 AS balance_micro, SUBSTR(c_name, 10) AS serial,
 c_mktsegment || '-' || CAST(c_nationkey AS STRING) AS segment_code, c_custkey % 2 = 0 AS even, c_custkey * 1000 AS route_no, CASE WHEN c_custkey % 3 = 1 THEN 'r,' || c_name END AS remark FROM {customer}
""",
    "fx_element": """
SELECT o_orderkey AS gid, o_custkey AS owner_id, CASE o_orderkey % 9 WHEN 0 THEN 'Arqueta D' WHEN 1 THEN 'cr-2' WHEN 2 THEN 'OTROS' WHEN 3 THEN 'Poste 8m' WHEN 4 THEN 'ARM' WHEN 5 THEN CAST(NULL AS STRING) WHEN 6 THEN 'canal' WHEN 7 THEN 'otros' ELSE 'PED' END AS kind,
 CASE o_orderkey % 4 WHEN 0 THEN 'ver CR' WHEN 1 THEN CAST(NULL AS STRING) ELSE 'ver cr' END AS note, CASE o_orderkey % 5 WHEN 0 THEN '0' WHEN 1 THEN CAST(NULL AS STRING) ELSE '2' END AS uso FROM {orders}
""",
    "fx_conduct": """
SELECT l_suppkey AS owner_id, CASE WHEN l_linenumber = 3 THEN CAST(NULL AS DOUBLE) ELSE l_quantity END AS length_dm FROM {lineitem}
""",
    "fx_md": """
SELECT p_partkey AS id, p_partkey % 100 * 2 AS owner_id FROM {part}
""",
    "fx_points": """
SELECT o_orderkey AS gid_element, CAST(o_orderkey * 37 % 100 AS DOUBLE) AS x, CAST(o_custkey * 53 % 100 AS DOUBLE) AS y FROM {orders}
""",
    "fx_area_edges": """
SELECT CAST(area_id AS INT) AS area_id, name, seq, x1, y1, x2, y2 FROM (VALUES (1,'box',1,10e0,10e0,40e0,10e0),(1,'box',2,40e0,10e0,40e0,40e0),(1,'box',3,40e0,40e0,10e0,40e0),(1,'box',4,10e0,40e0,10e0,10e0),
 (2,'tri',1,30e0,30e0,90e0,30e0),(2,'tri',2,90e0,30e0,60e0,90e0),(2,'tri',3,60e0,90e0,30e0,30e0),
 (3,'ell',1,50e0,5e0,95e0,5e0),(3,'ell',2,95e0,5e0,95e0,50e0),(3,'ell',3,95e0,50e0,80e0,50e0),(3,'ell',4,80e0,50e0,80e0,20e0),(3,'ell',5,80e0,20e0,50e0,20e0),(3,'ell',6,50e0,20e0,50e0,5e0),
 (4,'box',1,20e0,20e0,60e0,20e0),(4,'box',2,60e0,20e0,60e0,60e0),(4,'box',3,60e0,60e0,20e0,60e0),(4,'box',4,20e0,60e0,20e0,20e0)) AS t(area_id, name, seq, x1, y1, x2, y2)
""",
    "fx_zone_edges": """
SELECT CAST(area_id AS INT) AS area_id, name, seq, x1, y1, x2, y2 FROM (VALUES (1,'west',1,0e0,0e0,50e0,0e0),(1,'west',2,50e0,0e0,50e0,100e0),(1,'west',3,50e0,100e0,0e0,100e0),(1,'west',4,0e0,100e0,0e0,0e0),
 (2,'corner',1,70e0,70e0,70.5e0,70e0),(2,'corner',2,70.5e0,70e0,70.5e0,70.5e0),(2,'corner',3,70.5e0,70.5e0,70e0,70e0)) AS t(area_id, name, seq, x1, y1, x2, y2)
""",
}

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_PLACEHOLDER = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def base_tables_of(name: str) -> list[str]:
    """Driver tables a stand-in view reads."""
    return sorted(set(_PLACEHOLDER.findall(FX_SQL[name])))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one stand-in view on Spark from the driver parquet tables."""
    frames = {t: read_table(spark, sf_dir, t) for t in base_tables_of(name)}
    return spark.sql(FX_SQL[name], **frames)


def fixtures(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: fixture(spark, sf_dir, n) for n in names}


def oracle_ctes(*names: str) -> str:
    """``WITH`` clause defining the named stand-in views for the DuckDB oracle."""
    parts = []
    for n in names:
        text = FX_SQL[n].format(**{t: t for t in base_tables_of(n)})
        parts.append(f"{n} AS MATERIALIZED ({text.strip()})")
    return "WITH " + ",\n".join(parts) + "\n"


def api_items(orders: DataFrame) -> DataFrame:
    """Stand-in for the tracker API payload, one JSON object per order: (id, item_json).

    ``subject`` alternates between text (even ids) and ``{"raw": text}`` (odd ids), and begins
    with ``{`` every 17th id; custom field 5 is the text "true" (even ids) or the boolean;
    ``status`` is a link object, JSON null every 13th id; ``type`` names dossier or
    request; custom fields 1-4 carry status, priority, customer (JSON null every
    7th id) and the order key.
    """
    k = F.col("o_orderkey")
    text = F.concat(F.when(k % 17 == 0, F.lit("{ORD-")).otherwise(F.lit("ORD-")), k.cast("string"))
    subject = F.when(k % 2 == 0, F.to_json(F.array(text)).substr(F.lit(2), F.length(F.to_json(F.array(text))) - 2)) \
        .otherwise(F.to_json(F.struct(text.alias("raw"))))
    rest = F.struct(
        k.alias("id"),
        F.when(k % 13 != 0, F.struct(F.col("o_orderstatus").alias("name"))).alias("status"),
        F.struct(F.when(k % 3 == 0, F.lit("Request")).otherwise(F.lit("Dossier")).alias("name")).alias("type"),
        F.col("o_orderstatus").alias("customField1"),
        F.col("o_orderpriority").alias("customField2"),
        F.when(k % 7 != 0, F.col("o_custkey")).alias("customField3"),
        k.alias("customField4"),
    )
    body = F.to_json(rest, {"ignoreNullFields": "false"})
    flag = F.when(k % 2 == 0, F.lit('"true"')).otherwise(F.lit("true"))
    js = F.concat(F.lit('{"subject":'), subject, F.lit(',"customField5":'), flag, F.lit(","), body.substr(F.lit(2), F.length(body)))
    return orders.select(k.alias("id"), js.alias("item_json"))


def page_lines(items: DataFrame, page_size: int) -> DataFrame:
    """Stand-in for saved API answers: (place, value), one page a line in page order, ids dense from 0.

    Behind the last page come a broken line and a page that nobody may read.
    """
    page = (F.floor(F.col("id") / F.lit(page_size)) + 1).cast("long")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "item_json"))), lambda e: e["item_json"]), ",")
    pages = items.groupBy(page.alias("place")).agg(joined.alias("elements"))
    envelope = lambda no, elements: F.concat(F.lit('{"offset":'), no.cast("string"), F.lit(f',"pageSize":{page_size},"_embedded":{{"elements":['), elements, F.lit("]}}"))
    last = items.agg((F.floor(F.max("id") / F.lit(page_size)) + 1).cast("long").alias("last"))
    broken = last.select((F.col("last") + 1).alias("place"), F.lit('{"_embedded":{"elements":[{"id":').alias("value"))
    beyond = last.select((F.col("last") + 2).alias("place"), envelope(F.col("last") + 2, F.lit('{"id":-1}')).alias("value"))
    return pages.select("place", envelope(F.col("place"), F.col("elements")).alias("value")).unionByName(broken).unionByName(beyond)
