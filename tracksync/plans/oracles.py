"""SQL statements of the catalog's oracles for DuckDB, each written once from the meaning of an operator.

A fragment is text of one or more CTEs; the names of the tables it reads are parameters, so
that a single query and a step of the full run share it.
"""

from __future__ import annotations

from ..sources.fixtures import FIXTURE_CONFIG as CFG

ENTITY = CFG.entity_type


def history(items: str) -> str:
    """entries (item_id, state, state_ts) and latest (item_id, state, state_date)."""
    return f"""entries AS MATERIALIZED (
  SELECT item_id, entry->>'{CFG.history_state_key}' AS state, CAST(entry->>'{CFG.history_date_key}' AS TIMESTAMP) AS state_ts
  FROM (SELECT i.id AS item_id, unnest(CAST(h.hist AS JSON[])) AS entry FROM fx_history h, {items} i WHERE i.subject = h.num)),
latest AS MATERIALIZED (
  SELECT item_id, state, if(bool_or(state_ts IS NULL), NULL, strftime(max(state_ts), '%Y-%m-%d')) AS state_date
  FROM entries GROUP BY ALL)"""


def upsert(table: str, wanted: str, given: str, out: str) -> str:
    """``out``: rows of ``table`` with what ``given`` (item_id, attr, value) says, and one new row
    for every row of ``wanted`` (item_id, attr) whose item and field ``table`` lacks."""
    return f"""{out}_wanted AS MATERIALIZED (
  SELECT item_id, f.id AS field_id FROM {wanted} JOIN fx_fields f ON f.name = attr),
{out}_given AS MATERIALIZED (
  SELECT item_id, f.id AS field_id, min(value) AS told FROM {given} JOIN fx_fields f ON f.name = attr GROUP BY ALL),
{out}_held AS MATERIALIZED (
  SELECT DISTINCT customized_id AS item_id, custom_field_id AS field_id FROM {table} WHERE customized_type = '{ENTITY}'),
{out} AS MATERIALIZED (
  SELECT t.customized_type, t.customized_id, t.custom_field_id, if(g.item_id IS NULL, t.value, g.told) AS value
  FROM {table} t LEFT JOIN {out}_given g ON g.item_id = t.customized_id AND g.field_id = t.custom_field_id
  UNION ALL
  SELECT '{ENTITY}', item_id, field_id, told
  FROM (SELECT * FROM {out}_wanted ANTI JOIN {out}_held USING (item_id, field_id)) LEFT JOIN {out}_given USING (item_id, field_id))"""


def attached(long_rows: str, items: str, out: str) -> str:
    return f"{out} AS MATERIALIZED (SELECT i.id AS item_id, attr, value FROM {items} i JOIN {long_rows} ON num = i.subject)"


ACTIVE = f"active AS MATERIALIZED (SELECT * FROM fx_registry WHERE operator_id = {CFG.operator_id})"

#: The fan-out in full: every element of a dossier with every conduct of it.
CAPACITY = f"""fan AS (
  SELECT a.num, a.installed, a.used, e.kind, c.length_dm
  FROM active a, LATERAL (SELECT kind FROM fx_element WHERE owner_id = a.id) e, LATERAL (SELECT length_dm FROM fx_conduct WHERE owner_id = a.id) c),
capacity AS MATERIALIZED (
  SELECT num, installed, used, CAST(sum(if(length_dm IS NULL, 0, 1)) AS BIGINT) AS cable_count,
         if(bool_or(contains(upper(kind), 'POSTE')), '{CFG.pole_yes}', '{CFG.pole_no}') AS has_pole
  FROM fan GROUP BY ALL),
capacity_long AS MATERIALIZED (
  SELECT num, attr, value FROM (SELECT num, CAST(installed AS VARCHAR) AS installed_m, CAST(used AS VARCHAR) AS used_m,
                                       CAST(cable_count AS VARCHAR) AS mesh_m, has_pole FROM capacity)
  UNPIVOT INCLUDE NULLS (value FOR attr IN (installed_m, used_m, mesh_m, has_pole)))"""

#: Classes of every element, with unknown kept apart from no.
MARKED = """marked AS MATERIALIZED (
  SELECT a.num, a.miga, a.state, chamber, box, cabinet, pole, duct, uso,
         NOT (chamber OR box OR cabinet OR pole OR duct) AS rest
  FROM active a JOIN (
    SELECT owner_id, uso, contains(k, 'CR') OR (k = 'OTROS' AND contains(note, 'CR')) AS chamber,
           contains(k, 'ARQ') OR (k = 'OTROS' AND NOT contains(note, 'CR')) AS box,
           contains(k, 'ARM') AS cabinet, contains(k, 'POSTE') AS pole, k IS NULL OR contains(k, 'CANAL') AS duct
    FROM (SELECT owner_id, note, uso, upper(kind) AS k FROM fx_element)) e ON e.owner_id = a.id)"""


def _sums(**flags: str) -> str:
    return ", ".join(f"CAST(sum(if({flag}, 1, 0)) AS BIGINT) AS {name}" for name, flag in flags.items())


BUCKETS = f"""buckets AS MATERIALIZED (
  SELECT num, miga, state, {_sums(n_chamber_used="chamber AND uso <> '0'", n_chamber_idle="chamber AND uso = '0'", n_box="box", n_cabinet="cabinet",
                                  n_pole="pole", n_duct="duct", n_rest="rest")}, count(*) AS total
  FROM marked GROUP BY ALL)"""


def buckets_long(idle: str, duct: str, rest: str) -> str:
    return f"""buckets_long AS MATERIALIZED (
  UNPIVOT (SELECT num, CAST(n_chamber_idle AS VARCHAR) AS {idle}, CAST(n_duct AS VARCHAR) AS {duct}, CAST(n_rest AS VARCHAR) AS {rest} FROM buckets)
  ON {idle}, {duct}, {rest} INTO NAME attr VALUE value)"""


CLASSES = f"""classes_long AS MATERIALIZED (
  UNPIVOT (SELECT num, CAST(n_cr AS VARCHAR) AS n_cr, CAST(n_arq AS VARCHAR) AS n_arq, CAST(n_arm AS VARCHAR) AS n_arm, CAST(n_pole AS VARCHAR) AS n_pole
           FROM (SELECT num, {_sums(n_cr="chamber", n_arq="box", n_arm="cabinet", n_pole="pole")} FROM marked GROUP BY num))
  ON n_cr, n_arq, n_arm, n_pole INTO NAME attr VALUE value)"""


def _text(column: str) -> str:
    if column.startswith("balance"):  # doubles as the source database writes them
        return rf"regexp_replace(CAST({column} AS VARCHAR), '\.0$', '')"
    return f"CAST({column} AS VARCHAR)"


TRI_STATE = f"coalesce(map {{TRUE: '{CFG.tri_true}', FALSE: '{CFG.tri_false}'}}[hidden], '{CFG.tri_null}')"
SCALARS = f"""scalars AS MATERIALIZED (
  SELECT num, attr, value FROM (SELECT num, {", ".join(f'{_text(c)} AS "{lab}"' for lab, c in CFG.registry_scalars)}, {TRI_STATE} AS {CFG.registry_tristate[0]} FROM active)
  UNPIVOT INCLUDE NULLS (value FOR attr IN ({", ".join(f'"{lab}"' for lab, _ in CFG.registry_scalars)}, {CFG.registry_tristate[0]})))"""

DOCS = """docs AS MATERIALIZED (
  SELECT num, CAST(sum((SELECT count(m.id) FROM fx_md m WHERE m.owner_id = active.id)) AS BIGINT) AS n_docs FROM active GROUP BY num)"""


def points_in(edges: str, out: str) -> str:
    """Every point against every edge of every area: on an edge, or an odd number of crossings to the right."""
    return f"""{out} AS MATERIALIZED (
  SELECT p.gid_element, any_value(a.name) AS name FROM fx_points p, {edges} a
  GROUP BY p.gid_element, p.x, p.y, a.area_id
  HAVING bool_or((a.x2 - a.x1) * (p.y - a.y1) - (a.y2 - a.y1) * (p.x - a.x1) = 0
                 AND p.x BETWEEN least(a.x1, a.x2) AND greatest(a.x1, a.x2)
                 AND p.y BETWEEN least(a.y1, a.y2) AND greatest(a.y1, a.y2))
      OR SUM(CASE WHEN (a.y1 > p.y) <> (a.y2 > p.y)
                   AND p.x < (a.x2 - a.x1) * (p.y - a.y1) / (a.y2 - a.y1) + a.x1 THEN 1 ELSE 0 END) % 2 = 1)"""


def tags(label: str, points: str) -> str:
    return f"""tags_{label} AS MATERIALIZED (
  SELECT num, '{label}' AS attr, t.name AS value FROM {points} t, fx_element e, active WHERE t.gid_element = e.gid AND e.owner_id = active.id)"""


AREAS = ", ".join([points_in("fx_area_edges", "in_area"), tags("area", "in_area"), points_in("fx_zone_edges", "in_zone"), tags("zone", "in_zone")])
REGISTRY = ", ".join([ACTIVE, MARKED, CLASSES, SCALARS, DOCS, AREAS]) + """,
registry_long AS MATERIALIZED (
  FROM scalars UNION ALL SELECT num, 'final_docs', CAST(n_docs AS VARCHAR) FROM docs
  UNION ALL FROM tags_area UNION ALL FROM tags_zone UNION ALL FROM classes_long)"""


# -- rules: the whole table, with ``hit`` where the rule applies ------------------------------

def decimal_comma(table: str, out: str) -> str:
    return f"""{out} AS MATERIALIZED (
  SELECT t.* REPLACE (if(hit, translate(value, ',', '.'), value) AS value)
  FROM (SELECT v.*, coalesce(contains(v.value, ',') AND v.custom_field_id IN (FROM (SELECT id FROM fx_fields WHERE field_format = '{CFG.float_format}')), FALSE) AS hit
        FROM {table} v) t)"""


def recode(table: str, out: str) -> str:
    pairs = ", ".join(f"({CFG.recode_field_id}, '{a}', '{b}')" for a, b in CFG.recode_map)
    return f"""{out}_map(field_id, old, fresh) AS (VALUES {pairs}),
{out} AS MATERIALIZED (
  SELECT v.* REPLACE (coalesce(fresh, value) AS value), fresh IS NOT NULL AS hit
  FROM {table} v LEFT JOIN {out}_map ON field_id = v.custom_field_id AND old = v.value)"""


def route(items: str, values: str, item_type: int, suffix: str, out: str) -> str:
    """Items take the project that one of their partner values, with the suffix, names."""
    return f"""{out}_home AS MATERIALIZED (
  SELECT customized_id, min(p.id) AS home
  FROM (SELECT DISTINCT customized_id, value || '{suffix}' AS wanted FROM {values} WHERE custom_field_id IN (SELECT id FROM fx_fields WHERE name = '{CFG.partner_label}')) w
  JOIN fx_projects p ON p.name = w.wanted GROUP BY customized_id),
{out} AS MATERIALIZED (
  SELECT i.* REPLACE (if(hit, home, project_id) AS project_id), hit
  FROM (SELECT t.*, home, t.type_id = {item_type} AND home IS NOT NULL AS hit FROM {items} t LEFT JOIN {out}_home ON customized_id = t.id) i)"""


def due(values: str, out: str) -> str:
    """(customized_id, due_date): the date in the field named by the current state, plus the state's days."""
    return f"""{out}_now AS MATERIALIZED (
  SELECT customized_id, d.state, d.add_days, f.id AS field_id
  FROM fx_state_days d JOIN fx_fields f ON f.name = d.state JOIN (SELECT * FROM {values} WHERE custom_field_id = {CFG.state_field_id}) s ON s.value = d.state),
{out} AS MATERIALIZED (
  SELECT n.customized_id, strftime(CAST(b.value AS DATE) + to_days(n.add_days), '%Y-%m-%d') AS due_date
  FROM (SELECT * FROM {values} WHERE custom_field_id IN (SELECT field_id FROM {out}_now)) b JOIN {out}_now n ON n.customized_id = b.customized_id AND n.field_id = b.custom_field_id)"""


def due_update(table: str, dates: str, out: str) -> str:
    return f"""{out}_one AS (SELECT customized_id AS item, min(due_date) AS day FROM {dates} GROUP BY ALL),
{out} AS MATERIALIZED (
  SELECT v.* REPLACE (if(hit, day, value) AS value)
  FROM (SELECT t.*, day, item IS NOT NULL AND t.custom_field_id IN (SELECT id FROM fx_fields WHERE name = '{CFG.due_label}') AS hit
        FROM {table} t LEFT JOIN {out}_one ON item = t.customized_id) v)"""


def links(items: str, values: str, relations: str, out: str) -> str:
    """Requests with the dossiers they refer to, without the pairs joined by an edge of either direction."""
    return f"""{out}_known AS MATERIALIZED (
  SELECT from_id AS a, to_id AS b FROM {relations} UNION SELECT to_id, from_id FROM {relations}),
{out} AS MATERIALIZED (
  SELECT r.id AS from_id, d.id AS to_id, '{CFG.relation_type}' AS relation_type
  FROM (SELECT customized_id, value FROM {values} WHERE customized_type = '{ENTITY}' AND custom_field_id = {CFG.ref_field_id}) v
  JOIN (SELECT id, subject FROM {items} WHERE type_id = {CFG.dossier_type}) d ON d.subject = v.value
  JOIN (SELECT id FROM {items} WHERE type_id = {CFG.request_type}) r ON r.id = v.customized_id
  ANTI JOIN {out}_known k ON k.a = r.id AND k.b = d.id)"""


def lacking(items: str, values: str, field_id: int, out: str) -> str:
    """New NULL rows of a field: the dossiers minus those that hold it."""
    return f"""{out} AS MATERIALIZED (
  SELECT '{ENTITY}' AS customized_type, id AS customized_id, {field_id} AS custom_field_id, CAST(NULL AS VARCHAR) AS value
  FROM (SELECT id FROM {items} WHERE type_id = {CFG.dossier_type}
        EXCEPT SELECT customized_id FROM {values} WHERE customized_type = '{ENTITY}' AND custom_field_id = {field_id}))"""


def fill(table: str, items: str, item_type: int, out: str) -> str:
    return f"""{out}_name AS MATERIALIZED (
  SELECT i.id AS item, regexp_replace(p.name, '\\s*{CFG.suffix_word}\\s*', '', 'gi') AS plain
  FROM fx_projects p JOIN {items} i ON i.project_id = p.id AND i.type_id = {item_type}),
{out} AS MATERIALIZED (
  SELECT v.* REPLACE (if(hit, plain, value) AS value)
  FROM (SELECT t.*, plain, item IS NOT NULL AND t.custom_field_id = {CFG.partner_field_id} AND t.customized_type = '{ENTITY}' AND coalesce(t.value, '') = '' AS hit
        FROM {table} t LEFT JOIN {out}_name ON item = t.customized_id) v)"""


def classify(table: str, items: str, values: str, out: str) -> str:
    """One row per item says which of the two probes holds a value; the pair picks the code."""
    a, b = CFG.probe_a_field_id, CFG.probe_b_field_id
    return f"""{out}_seen AS MATERIALIZED (
  SELECT customized_id AS item, bool_or(custom_field_id = {a}) AS has_a, bool_or(custom_field_id = {b}) AS has_b
  FROM {values} WHERE customized_type = '{ENTITY}' AND custom_field_id IN ({a}, {b}) AND value IS NOT NULL GROUP BY ALL),
{out}_code AS MATERIALIZED (
  SELECT i.id AS item, [['{CFG.code_none}', '{CFG.code_only_b}'], ['{CFG.code_only_a}', '{CFG.code_both}']][1 + CAST(coalesce(has_a, FALSE) AS INT)][1 + CAST(coalesce(has_b, FALSE) AS INT)] AS code
  FROM {items} i LEFT JOIN {out}_seen s ON s.item = i.id WHERE i.type_id = {CFG.dossier_type}),
{out} AS MATERIALIZED (
  SELECT v.* REPLACE (if(hit, code, value) AS value)
  FROM (SELECT t.*, code, code IS NOT NULL AND t.customized_type = '{ENTITY}' AND t.custom_field_id = {CFG.class_field_id} AS hit
        FROM {table} t LEFT JOIN {out}_code c ON c.item = t.customized_id) v)"""


def reroute(items: str, values: str, relations: str, out: str) -> str:
    """From the edges outward: an edge request -> dossier counts if the request refers to that dossier."""
    return f"""{out}_home AS MATERIALIZED (
  SELECT e.to_id, min(child.parent_id) AS home
  FROM (SELECT DISTINCT from_id, to_id FROM {relations}) e
  JOIN (SELECT id, project_id FROM {items} WHERE type_id = {CFG.request_type}) r ON r.id = e.from_id
  JOIN (SELECT id, subject FROM {items} WHERE type_id = {CFG.dossier_type}) d ON d.id = e.to_id
  SEMI JOIN (SELECT customized_id, value FROM {values} WHERE customized_type = '{ENTITY}' AND custom_field_id = {CFG.ref_field_id}) v
    ON v.customized_id = e.from_id AND v.value = d.subject
  JOIN fx_projects child ON child.id = r.project_id
  WHERE child.parent_id IN (SELECT id FROM fx_projects) GROUP BY e.to_id),
{out} AS MATERIALIZED (
  SELECT i.* REPLACE (coalesce(home, project_id) AS project_id), home IS NOT NULL AS hit FROM {items} i LEFT JOIN {out}_home ON to_id = i.id)"""
