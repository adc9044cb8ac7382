"""Independent DuckDB SQL for every catalogue query (the correctness oracle).

The fixture views are shared with the Spark side (``roles.py``); everything
after them is written here in plain SQL from the operator semantics, not
generated from the Spark plans.  Tables ``lineitem``, ``orders``, ... are the
driver's pre-registered views.
"""

from __future__ import annotations

import re

from lakework.plans.roles import MIN_IMAGES, ROLE_SQL, RUNS, SOURCE_SYSTEM


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ts(x: str) -> str:
    """C13 on the fixture texts (ISO timestamp or date; other text → null)."""
    return f"coalesce(try_strptime({x}, '%Y-%m-%d %H:%M:%S'), try_strptime({x}, '%Y-%m-%d'))"


def _survey_ts(x: str) -> str:
    """The survey export's own format, or ISO."""
    return f"coalesce(try_strptime({x}, '%m/%d/%Y %I:%M:%S%p'), {_ts(x)})"


def _lit_nulls(x: str) -> str:
    return f"CASE WHEN trim({x}) IN ('', 'nan', 'NaT') THEN NULL ELSE trim({x}) END"


def _nt(x: str) -> str:
    return f"CASE WHEN lower(trim({x})) IN ('', 'null', 'none', 'nan', 'na', 'n/a') THEN NULL ELSE trim({x}) END"


def _run(name: str) -> tuple[str, str]:
    rd, rid = RUNS[name]
    return _q(rd), _q(rid)


# --- CTE library: name -> SQL body ------------------------------------------------

CTE: dict[str, str] = {name: sql for name, sql in ROLE_SQL.items()}

_rd, _rid = _run("release_dist")
CTE["rel_dist"] = f"""
    SELECT floc, scope_id, rem AS scope_removal_date, rem IS NULL AS is_active, CAST(NULL AS BIGINT) AS visit_no,
           scope_id || '|' || floc AS scope_floc_key, vendor, {_rd} AS run_date, {_rid} AS run_id,
           'release_dist.xlsx' AS source_file_saved, 'Distribution' AS source_sheet
    FROM (SELECT trim(FLOC) AS floc, coalesce({_lit_nulls('SCOPE_ID')}, 'COMP') AS scope_id,
                 {_ts(_lit_nulls('SCOPE_REMOVAL_DATE'))} AS rem, trim(vendor) AS vendor
          FROM release_dist_raw)"""

_rd, _rid = _run("release_trans")
CTE["rel_trans"] = f"""
    SELECT floc, scope_id, rem AS scope_removal_date, rem IS NULL AS is_active, visit_no,
           scope_id || '|' || floc AS scope_floc_key, vendor, {_rd} AS run_date, {_rid} AS run_id,
           'release_trans.xlsx' AS source_file_saved, 'Transmission' AS source_sheet
    FROM (SELECT trim(FLOC) AS floc, trim(s) AS scope_id, CAST(n AS BIGINT) AS visit_no,
                 {_ts(_lit_nulls('Date_Removed'))} AS rem, trim(vendor) AS vendor
          FROM (SELECT *, pkg_1 AS s, 1 AS n FROM release_trans_raw
                UNION ALL SELECT *, pkg_2 AS s, 2 AS n FROM release_trans_raw
                UNION ALL SELECT *, pkg_3 AS s, 3 AS n FROM release_trans_raw))
    WHERE scope_id IS NOT NULL AND scope_id <> ''"""

_hd, _hid = _run("helo")
for _name, _raw, _sheet in (("helo_d", "helo_dist_raw", "Distribution"), ("helo_t", "helo_trans_raw", "Transmission")):
    CTE[_name] = f"""
    SELECT floc, scope_id, CAST(NULL AS TIMESTAMP) AS scope_removal_date, TRUE AS is_active,
           CAST(NULL AS BIGINT) AS visit_no, scope_id || '|' || floc AS scope_floc_key, vendor,
           {_hd} AS run_date, {_hid} AS run_id, 'helo_tracker.xlsx' AS source_file_saved, '{_sheet}' AS source_sheet
    FROM (SELECT trim(FLOC) AS floc, trim(SCOPE_ID) AS scope_id, trim(vendor) AS vendor FROM {_raw})
    WHERE floc IS NOT NULL AND floc <> '' AND scope_id IS NOT NULL AND scope_id <> ''"""

def _event_sql(raw: str, event_type: str, sheet: str, effective: str, where: str = "TRUE") -> str:
    """Lines of one event sheet; transmission sheets have a line per filled slot."""
    scope = f"coalesce({_lit_nulls('SCOPE_ID')}, 'COMP')" if sheet == "Distribution" else "trim(s)"
    src = raw if sheet == "Distribution" else f"(SELECT *, pkg_1 AS s, 1 AS n FROM {raw} UNION ALL SELECT *, pkg_2 AS s, 2 AS n FROM {raw})"
    visit = "CAST(NULL AS BIGINT)" if sheet == "Distribution" else "CAST(n AS BIGINT)"
    return f"""
    SELECT floc, scope_id, event_type, event_effective_date, visit_no, scope_id || '|' || floc AS scope_floc_key, vendor, run_date, run_id,
           'events.xlsx' AS source_file_saved, '{sheet}' AS source_sheet
    FROM (SELECT trim(FLOC) AS floc, {scope} AS scope_id, {event_type} AS event_type, {effective} AS event_effective_date,
                 {visit} AS visit_no, trim(vendor) AS vendor, run_date, run_id
          FROM {src} WHERE {where})
    WHERE event_effective_date IS NOT NULL AND floc IS NOT NULL AND floc <> '' AND scope_id IS NOT NULL AND scope_id <> ''"""


CTE["ev_rem"] = " UNION ALL ".join(
    _event_sql(f"events_removal_{short}_raw", "'removal'", sheet, _ts(_lit_nulls(col)))
    for short, sheet, col in (("dist", "Distribution", "SCOPE_REMOVAL_DATE"), ("trans", "Transmission", "Date_Removed"))
)
CTE["ev_move"] = " UNION ALL ".join(
    _event_sql(f"events_move_{short}_raw", "'move_to_helo'", sheet, _ts("run_date")) for short, sheet in (("dist", "Distribution"), ("trans", "Transmission"))
)
CTE["ev_other"] = " UNION ALL ".join(
    _event_sql("events_raw", "event_type", sheet, _ts("run_date"), f"asset_class = '{sheet}' AND event_type NOT IN ('removal', 'move_to_helo')")
    for sheet in ("Distribution", "Transmission")
)
CTE["ev_all"] = "SELECT * FROM ev_rem UNION ALL SELECT * FROM ev_move UNION ALL SELECT * FROM ev_other"

CTE["latest"] = """
    SELECT vendor, scope_floc_key, event_type, event_effective_date, run_date, run_id, source_file_saved,
           source_sheet, visit_no, scope_id, floc
    FROM (SELECT *, row_number() OVER (
              PARTITION BY vendor, scope_floc_key
              ORDER BY event_effective_date DESC NULLS LAST, run_date DESC NULLS LAST,
                       CASE event_type WHEN 'move_to_helo' THEN 2 WHEN 'removal' THEN 1 ELSE 0 END DESC,
                       run_id DESC NULLS LAST, event_type ASC NULLS LAST, source_file_saved ASC NULLS LAST,
                       source_sheet ASC NULLS LAST, visit_no ASC NULLS LAST, scope_id ASC NULLS LAST,
                       floc ASC NULLS LAST) AS rn
          FROM ev_all)
    WHERE rn = 1"""

_gd, _gid = _run("gold")
for _cls, _drone, _helo, _sfx in (
    ("Distribution", "rel_dist", "helo_d", "d"),
    ("Transmission", "rel_trans", "helo_t", "t"),
):
    _low = _cls.lower()
    CTE[f"asg_{_sfx}"] = f"""
    SELECT *, 'DRONE' AS assignment_method, '{_cls}' AS asset_class, 'scope_release_{_low}' AS source_dataset,
           is_active AS base_is_active FROM {_drone}
    UNION ALL
    SELECT *, 'HELO' AS assignment_method, '{_cls}' AS asset_class, 'helo_scope_{_low}' AS source_dataset,
           TRUE AS base_is_active FROM {_helo}"""
    CTE[f"pref_{_sfx}"] = f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY vendor, scope_floc_key
            ORDER BY CASE assignment_method WHEN 'HELO' THEN 2 WHEN 'DRONE' THEN 1 ELSE 0 END DESC,
                     run_date DESC NULLS LAST, run_id DESC NULLS LAST, source_dataset ASC NULLS LAST,
                     visit_no ASC NULLS LAST, scope_removal_date DESC NULLS FIRST,
                     source_file_saved ASC NULLS LAST, source_sheet ASC NULLS LAST,
                     floc ASC NULLS LAST, scope_id ASC NULLS LAST) AS rn
        FROM asg_{_sfx})
    WHERE rn = 1"""
    CTE[f"cur_{_sfx}"] = f"""
    SELECT *,
           CASE WHEN coalesce(event_type, '') = 'removal' THEN 'REMOVED'
                WHEN coalesce(event_type, '') = 'move_to_helo' AND assignment_method = 'HELO' THEN 'ACTIVE_HELO'
                WHEN coalesce(event_type, '') = 'move_to_helo' AND assignment_method = 'DRONE' THEN 'MOVED_TO_HELO'
                WHEN (event_type IS NULL OR event_type = '') AND assignment_method = 'HELO' AND is_active_assignment THEN 'ACTIVE_HELO'
                WHEN (event_type IS NULL OR event_type = '') AND assignment_method = 'DRONE' AND is_active_assignment THEN 'ACTIVE_DRONE'
                WHEN (event_type IS NULL OR event_type = '') AND NOT is_active_assignment THEN 'INACTIVE'
           END AS assignment_status,
           {_gd} AS gold_run_date, {_gid} AS gold_run_id
    FROM (SELECT p.*, e.event_type, e.event_effective_date,
                 e.event_type AS latest_event_type, e.event_effective_date AS latest_event_effective_date,
                 CASE WHEN coalesce(e.event_type, '') = 'removal' THEN FALSE
                      WHEN coalesce(e.event_type, '') = 'move_to_helo' AND p.assignment_method = 'HELO' THEN TRUE
                      WHEN coalesce(e.event_type, '') = 'move_to_helo' AND p.assignment_method = 'DRONE' THEN FALSE
                      ELSE p.base_is_active END AS is_active_assignment
          FROM pref_{_sfx} p
          LEFT JOIN latest e ON p.vendor = e.vendor AND p.scope_floc_key = e.scope_floc_key)"""

_dd, _did = _run("deliveries")
CTE["dl_all"] = f"""
    SELECT asset_class, vendor, floc, scope_id, block_id, scope_id || '|' || floc AS scope_floc_key,
           date_uploaded, flight_date, folder_date, folder, image_count, image_count > 0 AS has_deliveries_evidence,
           'GCP' AS source_system, {_dd} AS run_date, {_did} AS run_id, 'deliveries.csv' AS source_file_saved
    FROM (SELECT asset_class, vendor, structureId AS floc, folder,
                 split_part(split_part(folder, '_', 1), '-', 1) AS scope_id,
                 CASE WHEN strpos(split_part(folder, '_', 1), '-') > 0
                      THEN substr(split_part(folder, '_', 1), strpos(split_part(folder, '_', 1), '-') + 1) END AS block_id,
                 CAST(try_strptime(regexp_extract(folder, '([^_]*)$', 1), '%Y%m%d') AS DATE) AS folder_date,
                 CAST(try_strptime(trim(DateUploaded), '%m-%d-%Y') AS DATE) AS date_uploaded,
                 CAST(try_strptime(trim(flight_date), '%m-%d-%Y') AS DATE) AS flight_date,
                 CAST(trunc(coalesce(TRY_CAST(nullif(trim(imageCount), '') AS DOUBLE), 0)) AS BIGINT) AS image_count
          FROM deliveries_raw)"""
CTE["dl"] = """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY asset_class, vendor, floc, folder
            ORDER BY date_uploaded DESC NULLS LAST, flight_date DESC NULLS LAST, run_date DESC NULLS LAST,
                     run_id DESC NULLS LAST, image_count DESC, scope_id ASC NULLS LAST) AS rn
        FROM dl_all)
    WHERE rn = 1"""
CTE["dagg"] = f"""
    SELECT asset_class, vendor, scope_floc_key, min(floc) AS floc_any, min(scope_id) AS scope_id_any,
           count(DISTINCT folder) AS folder_count, CAST(sum(image_count) AS BIGINT) AS image_count_total,
           coalesce(sum(image_count), 0) > 0 AS has_gcp_delivery,
           coalesce(sum(image_count), 0) >= {MIN_IMAGES} AS has_min_images
    FROM dl GROUP BY asset_class, vendor, scope_floc_key"""

_sd, _sid = _run("survey")
CTE["sl"] = f"""
    SELECT * FROM (
    SELECT 'distribution' AS asset_class, {_nt('flocNumber')} AS floc,
           {_survey_ts(_nt('createdAt'))} AS created_at,
           {_nt('aerialInspectionKind')} AS aerial_inspection_kind,
           {_nt('aerialMeasurementDocument')} AS aerial_measurement_document,
           {_nt('inspectionKind')} AS ground_inspection_kind,
           {_nt('measurementDocument')} AS ground_measurement_document,
           {_nt('inspectionStatus')} AS inspection_status,
           {_nt('objectType')} AS object_type,
           {_nt('workOrderNumber')} AS work_order_number,
           CASE upper({_nt('readyToSync')}) WHEN 'TRUE' THEN TRUE WHEN 'FALSE' THEN FALSE END AS ready_to_sync,
           {_nt('measurementDocument')} IS NOT NULL AS has_ground_mdoc,
           {_nt('aerialMeasurementDocument')} IS NOT NULL AS has_aerial_mdoc,
           ({_nt('measurementDocument')} IS NOT NULL OR {_nt('aerialMeasurementDocument')} IS NOT NULL) AS has_any_mdoc,
           'AZURE' AS source_system, {_sd} AS run_date, {_sid} AS run_id, 'survey.csv' AS source_file_saved,
           src_pos
    FROM survey_raw) WHERE floc IS NOT NULL"""

_SURVEY_JOINED = {
    "object_types": "object_type",
    "inspection_statuses": "inspection_status",
    "aerial_inspection_kinds": "aerial_inspection_kind",
    "ground_inspection_kinds": "ground_inspection_kind",
    "aerial_measurement_documents": "aerial_measurement_document",
    "ground_measurement_documents": "ground_measurement_document",
    "work_order_numbers": "work_order_number",
}


def _joined_unique_sql(src: str, group: list[str], values: dict[str, str], pos: str) -> str:
    g = ", ".join(group)
    unions = " UNION ALL ".join(f"SELECT {g}, {pos} AS p, '{n}' AS n, {v} AS v FROM {src}" for n, v in values.items())
    pivots = ", ".join(f"max(CASE WHEN n = '{n}' THEN s END) AS {n}" for n in values)
    return f"""
    SELECT {g}, {pivots} FROM (
        SELECT {g}, n, string_agg(v, ';' ORDER BY p) AS s FROM (
            SELECT {g}, n, v, min(p) AS p FROM ({unions}) WHERE v IS NOT NULL GROUP BY {g}, n, v)
        GROUP BY {g}, n)
    GROUP BY {g}"""


CTE["sl_ju"] = _joined_unique_sql("sl", ["asset_class", "floc"], _SURVEY_JOINED, "src_pos")
CTE["sroll"] = f"""
    SELECT s.*, {", ".join("j." + n for n in _SURVEY_JOINED)}, {_sd} AS run_date, {_sid} AS run_id
    FROM (SELECT asset_class, floc, min(created_at) AS created_at_min, max(created_at) AS created_at_max,
                 count(DISTINCT object_type) AS object_type_count, count(*) AS row_count,
                 bool_or(has_any_mdoc) AS has_any_mdoc, bool_or(has_ground_mdoc) AS has_ground_mdoc,
                 bool_or(has_aerial_mdoc) AS has_aerial_mdoc
          FROM sl GROUP BY asset_class, floc) s
    LEFT JOIN sl_ju j ON s.asset_class = j.asset_class AND s.floc = j.floc"""
CTE["sstd"] = """
    SELECT trim(floc) AS floc, coalesce(has_any_mdoc, FALSE) AS has_any_mdoc,
           coalesce(has_aerial_mdoc, FALSE) AS has_aerial_mdoc, coalesce(has_ground_mdoc, FALSE) AS has_ground_mdoc,
           aerial_measurement_documents, ground_measurement_documents, created_at_max, created_at_min,
           row_count, object_type_count
    FROM sroll"""

_md, _mid = _run("scope_master")
CTE["sm"] = f"""
    SELECT *, {_md} AS run_date, {_mid} AS run_id, 'SCOPE_MASTER' AS source_system FROM (
        SELECT trim(FLOC) AS floc, trim(Eq_OjType) AS object_type, nullif(trim(Voltage), '') AS voltage,
               'distribution' AS asset_class, 'DIST_LIST' AS scope_list, 'dist_list.xlsx' AS source_file_saved,
               0 AS list_idx, src_pos FROM scope_list_dist_raw
        UNION ALL
        SELECT trim(FLOC), trim(EqType), nullif(trim(kV), ''), 'transmission', 'TRANS_LIST', 'trans_list.xlsx',
               1, src_pos FROM scope_list_trans_raw
        UNION ALL
        SELECT trim(FLOC_ID), trim(Eq_ObjType), CAST(NULL AS VARCHAR), 'distribution', 'COMP_LIST', 'comp_list.xlsx',
               2, src_pos FROM scope_list_comp_raw)
    WHERE floc IS NOT NULL AND floc <> ''"""
CTE["sm_pos"] = "SELECT *, list_idx * 100000000000 + src_pos AS gpos FROM sm"
CTE["sm_ju"] = _joined_unique_sql(
    "sm_pos",
    ["floc"],
    {
        "object_type_values": "nullif(trim(object_type), '')",
        "voltage_values": "nullif(trim(voltage), '')",
        "scope_lists": "nullif(trim(scope_list), '')",
        "asset_classes": "nullif(trim(asset_class), '')",
    },
    "gpos",
)


def _parts(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, ';'), lambda e: trim(e)), lambda e: e <> '')"


CTE["fdim"] = f"""
    SELECT c.floc,
           CASE WHEN list_contains({_parts('j.object_type_values')}, 'EZ_POLE') THEN 'EZ_POLE'
                WHEN list_contains({_parts('j.object_type_values')}, 'ET_TOWER') THEN 'ET_TOWER'
                WHEN list_contains({_parts('j.object_type_values')}, 'ET_POLE') THEN 'ET_POLE'
                WHEN list_contains({_parts('j.object_type_values')}, 'ED_POLE') THEN 'ED_POLE'
                ELSE {_parts('j.object_type_values')}[1] END AS object_type,
           {_parts('j.voltage_values')}[1] AS voltage,
           j.object_type_values, j.voltage_values, j.scope_lists, j.asset_classes, c.row_count
    FROM (SELECT floc, count(*) AS row_count FROM sm GROUP BY floc) c
    LEFT JOIN sm_ju j ON c.floc = j.floc"""
CTE["fdimr"] = """
    SELECT floc, object_type, voltage FROM (
        SELECT trim(floc) AS floc, trim(object_type) AS object_type, nullif(trim(voltage), '') AS voltage,
               row_number() OVER (
                   PARTITION BY trim(floc)
                   ORDER BY CASE trim(object_type) WHEN 'EZ_POLE' THEN 4 WHEN 'ET_TOWER' THEN 3 WHEN 'ET_POLE' THEN 2
                                                   WHEN 'ED_POLE' THEN 1 ELSE 0 END DESC,
                            trim(object_type) ASC NULLS LAST, nullif(trim(voltage), '') ASC NULLS LAST) AS rn
        FROM fdim)
    WHERE rn = 1"""

_cd, _cid = _run("rate_card")
CTE["rc"] = f"""
    SELECT * FROM (
        SELECT trim(contractor) AS vendor, trim(program) AS billing_bucket,
               nullif(trim(object), '') AS object_type, nullif(trim(kv), '') AS voltage, 'FLOC' AS uom,
               TRY_CAST(rate AS DOUBLE) AS unit_price,
               CAST(NULL AS VARCHAR) AS effective_start_date, CAST(NULL AS VARCHAR) AS effective_end_date,
               CAST(10 + CASE WHEN nullif(trim(object), '') IS NOT NULL THEN 10 ELSE 0 END
                       + CASE WHEN nullif(trim(kv), '') IS NOT NULL THEN 10 ELSE 0 END AS BIGINT) AS priority,
               CAST(NULL AS VARCHAR) AS rule_name, {_cd} AS rate_run_date, {_cid} AS rate_run_id,
               'FINANCE' AS rate_source_system, rule_pos
        FROM rate_card_raw)
    WHERE vendor IS NOT NULL AND billing_bucket IS NOT NULL AND unit_price IS NOT NULL"""
CTE["prows"] = """
    SELECT *, row_number() OVER () AS rid FROM (
        SELECT nullif(trim(vendor), '') AS vendor, nullif(trim(billing_bucket), '') AS billing_bucket,
               nullif(trim(object_type), '') AS object_type, nullif(trim(voltage), '') AS voltage,
               l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
        FROM price_rows)"""
CTE["priced"] = """
    SELECT r.* EXCLUDE (rid), CAST(coalesce(a.n, 0) AS INTEGER) AS pricing_match_count, a.p AS unit_price,
           CASE WHEN coalesce(a.n, 0) = 0 THEN 'NO_MATCH' WHEN a.n = 1 THEN 'MATCHED' ELSE 'MULTI_MATCH' END
               AS pricing_match_status
    FROM prows r
    LEFT JOIN (
        SELECT r.rid, count(k.unit_price) AS n,
               first(k.unit_price ORDER BY (k.r_obj IS NOT NULL)::INT + (k.r_volt IS NOT NULL)::INT DESC, k.rule_pos ASC)
                   FILTER (WHERE k.unit_price IS NOT NULL) AS p
        FROM prows r
        JOIN (SELECT nullif(trim(vendor), '') AS vendor, nullif(trim(billing_bucket), '') AS bucket,
                     nullif(trim(object_type), '') AS r_obj,
                     CASE WHEN coalesce(nullif(trim(object_type), ''), '') = 'ET_TOWER' THEN nullif(trim(voltage), '') END AS r_volt,
                     unit_price, rule_pos
              FROM rc) k
          ON r.vendor IS NOT DISTINCT FROM k.vendor AND r.billing_bucket IS NOT DISTINCT FROM k.bucket
         AND (k.r_obj IS NULL OR k.r_obj = r.object_type)
         AND (k.r_volt IS NULL OR k.r_volt = CASE WHEN coalesce(r.object_type, '') = 'ET_TOWER' THEN r.voltage END)
        GROUP BY r.rid) a
      ON r.rid = a.rid"""

_ed, _eid = _run("eligibility")
_ELIG_LINEAGE = f"{_ed} AS eligibility_run_date, {_eid} AS eligibility_run_id, '{SOURCE_SYSTEM}' AS eligibility_source_system"


def _eligibility_ctes(version: str) -> None:
    v = version
    CTE[f"ed0_{v}"] = """
    SELECT c.vendor, c.scope_id, c.floc, c.scope_floc_key, f.object_type, f.voltage, c.assignment_method,
           c.assignment_status, coalesce(c.is_active_assignment, FALSE) AS act,
           CAST(coalesce(g.image_count_total, 0) AS BIGINT) AS img, CAST(coalesce(g.folder_count, 0) AS BIGINT) AS fc,
           coalesce(z.has_aerial_mdoc, FALSE) AS aer, coalesce(z.has_ground_mdoc, FALSE) AS gnd,
           coalesce(z.has_any_mdoc, FALSE) AS anym
    FROM cur_d c
    LEFT JOIN fdimr f ON c.floc = f.floc
    LEFT JOIN (SELECT * FROM dagg WHERE asset_class = 'distribution') g
      ON c.vendor = g.vendor AND c.scope_floc_key = g.scope_floc_key
    LEFT JOIN sstd z ON c.floc = z.floc"""
    if v == "v2":
        bucket = """CASE WHEN scope_id = 'COMP' THEN 'DIST_COMP' WHEN assignment_status = 'ACTIVE_DRONE' THEN 'DIST_DRONE'
                         WHEN assignment_status = 'ACTIVE_HELO' THEN 'DIST_HELO' ELSE 'DIST_OTHER' END"""
    else:
        bucket = """CASE WHEN assignment_status = 'ACTIVE_DRONE' THEN 'DIST_DRONE' WHEN assignment_status = 'ACTIVE_HELO' THEN 'DIST_HELO'
                         WHEN scope_id = 'COMP' THEN 'DIST_COMP' ELSE 'DIST_OTHER' END"""
    CTE[f"ed1_{v}"] = f"""
    SELECT *, pb IN ('DIST_DRONE', 'DIST_HELO') AS req_i, pb = 'DIST_DRONE' AS req_a,
           pb IN ('DIST_DRONE', 'DIST_COMP') AS req_g,
           CASE pb WHEN 'DIST_DRONE' THEN 'D360' WHEN 'DIST_COMP' THEN 'ODI' WHEN 'DIST_HELO' THEN 'HELO'
                   WHEN 'DIST_OTHER' THEN 'DIST_OTHER' ELSE pb END AS acr,
           coalesce(trim(object_type), '') = 'EZ_POLE' AS ez
    FROM (SELECT *, {bucket} AS pb FROM ed0_{v})"""
    CTE[f"ed2_{v}"] = f"""
    SELECT *, (NOT req_i OR img >= {MIN_IMAGES}) AND (NOT req_a OR aer) AND (NOT req_g OR gnd) AS meets,
           CASE WHEN ez THEN FALSE ELSE act AND acr <> 'DIST_OTHER' END AS billable,
           NOT act AS b1, req_i AND img < {MIN_IMAGES} AS b2, req_a AND NOT aer AS b3, req_g AND NOT gnd AS b4
    FROM ed1_{v}"""
    if v == "v2":
        CTE[f"elig_d_{v}"] = f"""
    SELECT 'distribution' AS asset_class, pb AS program_bucket, acr AS program_acronym,
           CASE WHEN ez THEN 'NON_BILLABLE' ELSE acr END AS billing_bucket, meets AS is_work_complete,
           billable AS is_billable, vendor, scope_id, floc, scope_floc_key, object_type, voltage, assignment_method,
           assignment_status, act AS is_active_assignment, img AS image_count_total, fc AS folder_count,
           aer AS has_aerial_mdoc, gnd AS has_ground_mdoc, anym AS has_any_mdoc, 'FLOC_ONLY' AS azure_join_method,
           meets AND billable AS approved_to_invoice,
           concat_ws(';', CASE WHEN b1 THEN 'BLOCK_INACTIVE_ASSIGNMENT' END,
                          CASE WHEN b2 THEN 'BLOCK_MISSING_GCP_MIN_IMAGES' END,
                          CASE WHEN b3 THEN 'BLOCK_MISSING_AERIAL_MDOC' END,
                          CASE WHEN b4 THEN 'BLOCK_MISSING_GROUND_MDOC' END,
                          CASE WHEN ez THEN 'BLOCK_EZ_POLE_DIST_NOT_BILLABLE' END) AS block_reasons,
           NOT (meets AND billable) AS needs_review, {_ELIG_LINEAGE}
    FROM ed2_{v}"""
    else:
        CTE[f"elig_d_{v}"] = f"""
    SELECT 'distribution' AS asset_class, pb AS program_bucket, vendor, scope_id, floc, scope_floc_key,
           assignment_method, assignment_status, act AS is_active_assignment, img AS image_count_total,
           fc AS folder_count, aer AS has_aerial_mdoc, gnd AS has_ground_mdoc, anym AS has_any_mdoc,
           'FLOC_ONLY' AS azure_join_method, act AND meets AS approved_to_invoice,
           concat_ws(';', CASE WHEN b1 THEN 'BLOCK_INACTIVE_ASSIGNMENT' END,
                          CASE WHEN b2 THEN 'BLOCK_MISSING_GCP_MIN_IMAGES' END,
                          CASE WHEN b3 THEN 'BLOCK_MISSING_AERIAL_MDOC' END,
                          CASE WHEN b4 THEN 'BLOCK_MISSING_GROUND_MDOC' END) AS block_reasons,
           NOT (act AND meets) AS needs_review, {_ELIG_LINEAGE}
    FROM ed2_{v}"""
    CTE[f"et0_{v}"] = """
    SELECT c.vendor, c.scope_id, c.floc, c.scope_floc_key, f.object_type, f.voltage, c.assignment_method,
           c.assignment_status, coalesce(c.is_active_assignment, FALSE) AS act,
           CAST(coalesce(g.image_count_total, 0) AS BIGINT) AS img, CAST(coalesce(g.folder_count, 0) AS BIGINT) AS fc
    FROM cur_t c
    LEFT JOIN fdimr f ON c.floc = f.floc
    LEFT JOIN (SELECT * FROM dagg WHERE asset_class = 'transmission') g
      ON c.vendor = g.vendor AND c.scope_floc_key = g.scope_floc_key"""
    if v == "v1":  # without evidence v1 has no folder count
        for name in (f"ed0_{v}", f"et0_{v}"):
            CTE[name] = CTE[name].replace("coalesce(g.folder_count, 0)", "g.folder_count")
    common_t = f"""vendor, scope_id, floc, scope_floc_key"""
    reasons_t = f"""concat_ws(';', CASE WHEN NOT act THEN 'BLOCK_INACTIVE_ASSIGNMENT' END,
                          CASE WHEN img < {MIN_IMAGES} THEN 'BLOCK_MISSING_GCP_MIN_IMAGES' END) AS block_reasons"""
    if v == "v2":
        CTE[f"elig_t_{v}"] = f"""
    SELECT 'transmission' AS asset_class, 'TRANS' AS program_bucket, 'ATI' AS program_acronym, 'ATI' AS billing_bucket,
           img >= {MIN_IMAGES} AS is_work_complete, act AS is_billable, {common_t}, object_type, voltage,
           assignment_method, assignment_status, act AS is_active_assignment, img AS image_count_total,
           fc AS folder_count, CAST(NULL AS BOOLEAN) AS has_aerial_mdoc, CAST(NULL AS BOOLEAN) AS has_ground_mdoc,
           CAST(NULL AS BOOLEAN) AS has_any_mdoc, CAST(NULL AS VARCHAR) AS azure_join_method,
           img >= {MIN_IMAGES} AND act AS approved_to_invoice, {reasons_t},
           NOT (img >= {MIN_IMAGES} AND act) AS needs_review, {_ELIG_LINEAGE}
    FROM et0_{v}"""
    else:
        CTE[f"elig_t_{v}"] = f"""
    SELECT 'transmission' AS asset_class, 'TRANS' AS program_bucket, {common_t}, assignment_method,
           assignment_status, act AS is_active_assignment, img AS image_count_total, fc AS folder_count,
           CAST(NULL AS BOOLEAN) AS has_aerial_mdoc, CAST(NULL AS BOOLEAN) AS has_ground_mdoc,
           CAST(NULL AS BOOLEAN) AS has_any_mdoc, CAST(NULL AS VARCHAR) AS azure_join_method,
           act AND img >= {MIN_IMAGES} AS approved_to_invoice, {reasons_t},
           NOT (act AND img >= {MIN_IMAGES}) AS needs_review, {_ELIG_LINEAGE}
    FROM et0_{v}"""
    CTE[f"elig_{v}"] = f"SELECT * FROM elig_d_{v} UNION ALL BY NAME SELECT * FROM elig_t_{v}"


_eligibility_ctes("v2")
_eligibility_ctes("v1")


def _snap_keyed(raw: str) -> str:
    sig = "sha256(concat_ws('|', " + ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), '')" for c in ("AMOUNT", "FLOC", "SCOPE_ID", "SCOPE_REMOVAL_DATE", "STATUS")
    ) + "))"
    return f"""
    SELECT *, _removal_dt IS NULL AS _is_active, _scope_id || '|' || _floc AS _key, {sig} AS _sig FROM (
        SELECT *, trim(FLOC) AS _floc, coalesce({_lit_nulls('SCOPE_ID')}, 'COMP') AS _scope_id,
               {_ts(_lit_nulls('SCOPE_REMOVAL_DATE'))} AS _removal_dt
        FROM {raw})"""


CTE["snap_prev"] = _snap_keyed("snapshot_prev_raw")
CTE["snap_cur"] = _snap_keyed("snapshot_cur_raw")
_SNAP_COLS = ("_key", "FLOC", "SCOPE_ID", "SCOPE_REMOVAL_DATE", "AMOUNT", "STATUS", "_is_active")
CTE["snap_delta"] = f"""
    SELECT CASE WHEN dt IN ('added_new', 'reactivated') THEN 'ADDED'
                WHEN dt IN ('removed_soft', 'removed_missing_in_current') THEN 'REMOVED' ELSE 'UPDATED' END AS change_set,
           dt AS _delta_type,
           {", ".join(f"CASE WHEN dt = 'removed_missing_in_current' THEN p_{c} ELSE c_{c} END AS {c}" for c in _SNAP_COLS)}
    FROM (
        SELECT *,
               CASE WHEN c_in AND NOT p_in AND c__is_active THEN 'added_new'
                    WHEN c_in AND p_in AND NOT p__is_active AND c__is_active THEN 'reactivated'
                    WHEN c_in AND p_in AND p__is_active AND NOT c__is_active THEN 'removed_soft'
                    WHEN NOT c_in AND p_in AND p__is_active THEN 'removed_missing_in_current'
                    WHEN c_in AND p_in AND p__is_active AND c__is_active AND c__sig <> p__sig THEN 'updated_active'
               END AS dt
        FROM (SELECT coalesce(c.c_in, FALSE) AS c_in, coalesce(p.p_in, FALSE) AS p_in, c.*, p.*
              FROM (SELECT TRUE AS c_in, {", ".join(f"{c} AS c_{c}" for c in (*_SNAP_COLS, "_sig"))} FROM snap_cur) c
              FULL OUTER JOIN (SELECT TRUE AS p_in, {", ".join(f"{c} AS p_{c}" for c in (*_SNAP_COLS, "_sig"))} FROM snap_prev) p
              ON c.c__key IS NOT DISTINCT FROM p.p__key))
    WHERE dt IS NOT NULL"""


# --- queries -----------------------------------------------------------------

_FINAL: dict[str, str] = {
    "release_line_distribution": "SELECT * FROM rel_dist",
    "release_line_transmission": "SELECT * FROM rel_trans",
    "helo_line": "SELECT * FROM helo_d UNION ALL SELECT * FROM helo_t",
    "assignment_lines": "SELECT * FROM asg_d UNION ALL SELECT * FROM asg_t",
    "events_history": "SELECT * FROM ev_all",
    "removal_events": "SELECT * FROM ev_rem",
    "move_events": "SELECT * FROM ev_move",
    "latest_event": "SELECT * FROM latest",
    "preferred_assignment": "SELECT * FROM pref_d",
    "scope_assignment_current": "SELECT * FROM cur_d UNION ALL SELECT * FROM cur_t",
    "deliveries_line": "SELECT * FROM dl",
    "deliveries_agg": "SELECT * FROM dagg",
    "survey_line": "SELECT * EXCLUDE (src_pos) FROM sl",
    "survey_rollup": "SELECT * FROM sroll",
    "scope_list_line": "SELECT * EXCLUDE (list_idx) FROM sm WHERE scope_list = 'TRANS_LIST'",
    "scope_master_union": "SELECT * EXCLUDE (list_idx, src_pos) FROM sm",
    "floc_attributes_dim": "SELECT * FROM fdim",
    "floc_dim_ranked": "SELECT * FROM fdimr",
    "rate_card": "SELECT * FROM rc",
    "unit_price": "SELECT * FROM priced",
    "pricing_status_counts": """
        SELECT pricing_match_status, count(*) AS n_rows, count(*) FILTER (WHERE unit_price IS NULL) AS n_price_null
        FROM priced GROUP BY pricing_match_status""",
    "invoice_eligibility_line": "SELECT * FROM elig_v2",
    "eligibility_v1": "SELECT * FROM elig_v1",
    "eligibility_scope_summary": f"""
        SELECT asset_class, vendor, scope_id, floc_count, approved_count, floc_count - approved_count AS blocked_count,
               CASE WHEN floc_count > 0 THEN CAST(approved_count AS DOUBLE) / floc_count ELSE 0.0 END AS approved_rate,
               {_ELIG_LINEAGE}
        FROM (SELECT asset_class, vendor, scope_id, count(scope_floc_key) AS floc_count,
                     count(*) FILTER (WHERE coalesce(approved_to_invoice, FALSE)) AS approved_count
              FROM elig_v2 GROUP BY asset_class, vendor, scope_id)""",
    "unmatched_deliveries": f"""
        SELECT g.asset_class, g.vendor, g.scope_id_any AS scope_id, g.floc_any AS floc, g.scope_floc_key,
               g.image_count_total, g.folder_count, g.has_gcp_delivery, g.has_min_images,
               'VENDOR_SCOPE_KEY_NOT_IN_ASSIGNMENTS' AS unmatched_reason, {_ELIG_LINEAGE}
        FROM dagg g
        WHERE NOT EXISTS (
            SELECT 1 FROM (SELECT 'distribution' AS ac, vendor, scope_floc_key FROM cur_d
                           UNION ALL SELECT 'transmission', vendor, scope_floc_key FROM cur_t) a
            WHERE a.ac = g.asset_class AND a.vendor = g.vendor AND a.scope_floc_key = g.scope_floc_key)""",
    "unmatched_surveys": f"""
        SELECT 'distribution' AS asset_class, z.*, 'FLOC_NOT_IN_DISTRIBUTION_ASSIGNMENTS' AS unmatched_reason,
               {_ELIG_LINEAGE}
        FROM sstd z WHERE NOT EXISTS (SELECT 1 FROM cur_d a WHERE trim(a.floc) = z.floc)""",
    "snapshot_delta": "SELECT * FROM snap_delta",
    "row_signature": """
        SELECT FLOC, sha256(concat_ws('|', coalesce(CAST(AMOUNT AS VARCHAR), ''), coalesce(FLOC, ''),
               coalesce(SCOPE_ID, ''), coalesce(SCOPE_REMOVAL_DATE, ''), coalesce(STATUS, ''))) AS row_sig
        FROM snapshot_cur_raw""",
}


def _deps(sql: str) -> list[str]:
    """CTE names referenced by ``sql``, transitively, in definition order."""
    order = list(CTE)
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in order:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(CTE[name])

    visit(sql)
    return [n for n in order if n in seen]


def build(name: str) -> str:
    body = _FINAL[name]
    deps = _deps(body)
    if not deps:
        return body
    # A view that several others read is computed once.
    texts = [body, *(CTE[n] for n in deps)]
    shared = {n for n in deps if sum(len(re.findall(rf"\b{n}\b", t)) for t in texts) > 1}
    return "WITH " + ",\n".join(f"{n} AS {'MATERIALIZED ' if n in shared and n not in ROLE_SQL else ''}({CTE[n]})" for n in deps) + "\n" + body


def oracle_sql() -> dict[str, str]:
    return {name: build(name) for name in _FINAL}


# --- invoices -------------------------------------------------------------------

def _entity_map() -> str:
    """MAP literal of the named character references."""
    from html.entities import html5

    return "MAP {" + ", ".join(f"{_q(k)}: {_q(v)}" for k, v in html5.items()) + "}"


#: One row with the references by name, and by number where Windows-1252 says what a number means.
CTE["refs"] = (
    f"SELECT {_entity_map()} AS named, MAP {{"
    + ", ".join(f"{n}: {_q(bytes([n]).decode('cp1252', 'ignore') or chr(n))}" for n in range(0x80, 0xA0))
    + "} AS windows"
)


def _number_ref(n: str) -> str:
    return f"""CASE WHEN {n} IS NULL OR {n} = 0 OR {n} BETWEEN 55296 AND 57343 OR {n} > 1114111 THEN chr(65533)
        WHEN {n} BETWEEN 128 AND 159 THEN windows[{n}]
        WHEN {n} BETWEEN 1 AND 8 OR {n} = 11 OR {n} BETWEEN 14 AND 31 OR {n} = 127 OR {n} BETWEEN 64976 AND 65007 OR {n} & 65534 = 65534 THEN ''
        ELSE chr(CAST({n} AS INTEGER)) END"""


def _unesc(x: str) -> str:
    """References of ``x`` replaced; needs the columns of ``refs``."""
    digits = "rtrim(t[3:], ';')"
    dec, hexa = f"TRY_CAST({digits} AS BIGINT)", f"TRY_CAST('0x' || {digits}[2:] AS BIGINT)"
    lead = "list_filter(range(length(t) - 2, 1, -1), lambda k: map_contains(named, t[2:k + 1]))[1]"
    token = f"""CASE WHEN t = '&' OR t[1] <> '&' THEN t
        WHEN lower(t[1:3]) = '&#x' THEN {_number_ref(hexa)}
        WHEN t[1:2] = '&#' THEN {_number_ref(dec)}
        WHEN map_contains(named, t[2:]) THEN named[t[2:]]
        WHEN {lead} IS NOT NULL THEN named[t[2:{lead} + 1]] || t[{lead} + 2:]
        ELSE t END"""
    cut = "'&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)|&|[^&]+'"
    return f"array_to_string(list_transform(regexp_extract_all({x}, {cut}), lambda t: {token}), '')"


def _norm_label(x: str) -> str:
    return f"lower(trim(regexp_replace({x}, '\\s+', ' ', 'g')))"


def _lines(html: str) -> str:
    h = f"regexp_replace({html}, '(?is)<\\s*br\\s*/?\\s*>', chr(10), 'g')"
    h = f"regexp_replace({h}, '(?is)</\\s*(p|tr|td|div|table)\\s*>', chr(10), 'g')"
    h = f"regexp_replace({h}, '(?is)<[^>]+>', '', 'g')"
    h = _unesc(h)
    h = f"replace({h}, chr(13), chr(10))"
    return f"list_filter(list_transform(string_split({h}, chr(10)), lambda x: trim(replace(x, chr(160), ' '))), lambda x: x <> '')"


def _tag(html: str, tag: str) -> str:
    inner = f"regexp_extract({html}, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>', 1)"
    t = _unesc(f"regexp_replace({inner}, '(?is)<[^>]+>', '', 'g')")
    return f"nullif(trim(regexp_replace({t}, '\\s+', ' ', 'g')), '')"


def _span(html: str, label: str) -> str:
    lab = label.replace("/", "/").replace("#", "#")
    lab = "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in lab)
    v = f"regexp_extract({html}, '(?is)>{lab}\\s*</span>.*?>\\s*([^<]+?)\\s*</span>', 1)"
    return f"nullif(trim(replace({v}, chr(160), ' ')), '')"


def _num(x: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract(replace({x}, ',', ''), '(-?\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE)"


def _iso_date(x: str) -> str:
    return (f"strftime(coalesce(TRY_CAST(nullif(trim({x}), '') AS TIMESTAMP), "
            f"try_strptime(nullif(trim({x}), ''), '%m/%d/%Y')), '%Y-%m-%d')")


_EMAIL = {
    "on_behalf_of_preparer": "On behalf of / Preparer",
    "invoice_reconciliation": "Invoice Reconciliation",
    "supplier_invoice_number": "Supplier Invoice #",
    "supplier": "Supplier",
    "invoice_date_text": "Invoice Date",
    "company_code": "Company Code",
    "total_amount_text": "Total Amount",
}
CTE["em_idx"] = """
    SELECT regexp_extract(file_name, '(?i)^email__([^_]+)_\\.html$', 1) AS message_id, file_name AS html_file, html
    FROM invoice_email_files WHERE regexp_matches(file_name, '(?i)^email__([^_]+)_\\.html$')"""
CTE["att_idx"] = """
    SELECT regexp_extract(file_name, '(?i)^att__([^_]+)__(.+)\\.xlsx$', 1) AS message_id, file_name AS attachment_file,
           regexp_extract(file_name, '(?i)^att__([^_]+)__(.+)\\.xlsx$', 2) AS invoice_name_from_attachment
    FROM invoice_attachment_files WHERE regexp_matches(file_name, '(?i)^att__([^_]+)__(.+)\\.xlsx$')"""
_KNOWN = "('on behalf of / preparer', 'supplier invoice #', 'supplier', 'invoice date', 'company code', 'total amount')"


def _next_line(label: str) -> str:
    """The line after the first one that is ``label`` and is followed by no label."""
    norm = lambda i: f"lower(trim(regexp_replace(lines[{i}], '\\s+', ' ', 'g')))"
    return f"lines[list_filter(range(1, len(lines)), lambda i: {norm('i')} = {_q(label.lower())} AND {norm('i + 1')} NOT IN {_KNOWN})[1] + 1]"


CTE["em_lines"] = f"SELECT message_id, html_file, html, {_lines('html')} AS lines FROM em_idx, refs"
CTE["em_raw"] = (
    "SELECT message_id, html_file, " + ", ".join(f"coalesce({_span('html', lab)}, {_next_line(lab)}) AS {k}" for k, lab in _EMAIL.items()) + " FROM em_lines"
)
CTE["em_v1"] = f"""
    SELECT *, {_iso_date('invoice_date_text')} AS invoice_date,
           nullif(regexp_extract(total_amount_text, '([A-Z]{{3}})\\s*$', 1), '') AS currency,
           {_num('total_amount_text')} AS total_amount
    FROM em_raw"""
CTE["em_v2"] = f"""
    SELECT message_id, on_behalf_of_preparer, supplier_invoice_number, supplier,
           coalesce({_iso_date('invoice_date_text')}, invoice_date_text) AS invoice_date, company_code,
           {_num('total_amount_text')} AS total_amount_value,
           nullif(regexp_extract(total_amount_text, '\\b([A-Z]{{3}})\\b', 1), '') AS total_amount_currency
    FROM em_raw"""
CTE["g_hr1"] = """
    SELECT message_id, min(row_idx) AS header_row FROM (
        SELECT message_id, row_idx FROM invoice_cells
        WHERE lower(trim(value)) IN ('floc_id', 'sce_struct', 'photo_loc', 'flight_date', 'upload_date',
                                                     'vendor_status', 'block_id', 'unit_rate')
        GROUP BY message_id, row_idx HAVING count(DISTINCT lower(trim(value))) = 8)
    GROUP BY message_id"""
CTE["g_hr2"] = f"""
    SELECT message_id, CAST(min(row_idx) FILTER (WHERE replace({_norm_label('value')}, ' ', '_') IN ('floc_id', 'flocid')) AS INTEGER) AS header_row
    FROM invoice_cells GROUP BY message_id"""
_KV1 = {
    "cwa_number": ("CWA #", "CWA#", "CWA"),
    "total_qty_structures": ("TOTAL QTY OF STRUCTURES", "TOTAL QTY", "TOTAL QTY OF STRUCTURE"),
    "invoice_date_excel": ("INVOICE DATE",),
    "invoice_number_excel": ("INVOICE NUMBER", "INVOICE #"),
    "purchase_order_number": ("PURCHASE ORDER NO.", "PURCHASE ORDER NO", "PO", "PO NUMBER"),
    "change_order_number": ("CHANGE ORDER NO.", "CHANGE ORDER NO", "CHANGE ORDER"),
    "payment_terms": ("PAYMENT TERMS",),
    "due_date_excel": ("DUE DATE",),
    "invoice_total_excel": ("INVOICE TOTAL", "TOTAL"),
}
_kv1_case = "CASE " + _norm_label("value") + " " + " ".join(
    f"WHEN {_q(lab.lower())} THEN {_q(key)}" for key, labs in _KV1.items() for lab in labs) + " END"
CTE["g_kv1_hits"] = f"""
    SELECT message_id, row_idx, col_idx, {_kv1_case} AS k,
           first_value(CASE WHEN trim(value) <> '' THEN value END IGNORE NULLS) OVER (
               PARTITION BY message_id, row_idx ORDER BY col_idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS rgt
    FROM invoice_cells"""
CTE["g_kv1_raw"] = """
    SELECT message_id, k, arg_max_null(nullif(trim(rgt), ''), row_idx * 1000 + col_idx) AS v
    FROM g_kv1_hits WHERE k IS NOT NULL GROUP BY message_id, k"""
CTE["g_kv1"] = "SELECT m.message_id, " + ", ".join(
    {
        "invoice_date_excel": f"{_iso_date('kv.invoice_date_excel')} AS invoice_date_excel",
        "due_date_excel": f"{_iso_date('kv.due_date_excel')} AS due_date_excel",
        "total_qty_structures": "coalesce(nullif(regexp_extract(kv.total_qty_structures, '\\d+', 0), ''), nullif(trim(kv.total_qty_structures), '')) AS total_qty_structures",
    }.get(k, f"kv.{k} AS {k}")
    for k in _KV1
) + f""", {_num('kv.invoice_total_excel')} AS invoice_total_excel_amount
    FROM (SELECT DISTINCT message_id FROM invoice_cells) m
    LEFT JOIN (SELECT message_id, """ + ", ".join(f"max(CASE WHEN k = '{k}' THEN v END) AS {k}" for k in _KV1) + """
               FROM g_kv1_raw GROUP BY message_id) kv ON m.message_id = kv.message_id"""
_KV2 = {
    "cwa_number": "cwa #", "total_qty_structures": "total qty of structures", "invoice_date_xlsx": "invoice date",
    "invoice_number_xlsx": "invoice number", "purchase_order_number": "purchase order no.",
    "change_order_number": "change order no.", "payment_terms": "payment terms", "due_date": "due date",
    "invoice_total_xlsx": "invoice total",
}
CTE["g_kv2"] = """
    SELECT m.message_id, """ + ", ".join(f"kv.{k}" for k in _KV2) + """
    FROM (SELECT DISTINCT message_id FROM invoice_cells) m
    LEFT JOIN (
        SELECT message_id, """ + ", ".join(f"arg_max(b, row_idx) FILTER (WHERE k = {_q(lab)}) AS {k}" for k, lab in _KV2.items()) + f"""
        FROM (SELECT a.message_id, a.row_idx, a.a, b.b, {_norm_label('a.a')} AS k
              FROM (SELECT message_id, row_idx, trim(replace(value, chr(160), ' ')) AS a FROM invoice_cells WHERE col_idx = 0) a
              JOIN (SELECT message_id, row_idx, trim(replace(value, chr(160), ' ')) AS b FROM invoice_cells WHERE col_idx = 1) b
                ON a.message_id = b.message_id AND a.row_idx = b.row_idx
              WHERE a.a <> '' AND b.b <> '')
        GROUP BY message_id) kv ON m.message_id = kv.message_id"""
_LC = ("FLOC_ID", "SCE_STRUCT", "PHOTO_LOC", "FLIGHT_DATE", "UPLOAD_DATE", "VENDOR_STATUS", "BLOCK_ID", "UNIT_RATE")


# Spellings of the columns, best first.
_SPELT = (
    ("FLOC_ID", "floc_id", 1), ("FLOC_ID", "flocid", 2), ("FLOC_ID", "floc", 3),
    ("SCE_STRUCT", "sce_struct", 1), ("SCE_STRUCT", "sce_struct_", 2), ("SCE_STRUCT", "sce_struct__", 3),
    ("PHOTO_LOC", "photo_loc", 1), ("PHOTO_LOC", "photo_loc_", 2), ("PHOTO_LOC", "photo_loc__", 3),
    ("FLIGHT_DATE", "flight_date", 1), ("FLIGHT_DATE", "flightdate", 2), ("UPLOAD_DATE", "upload_date", 1), ("UPLOAD_DATE", "uploaddate", 2),
    ("VENDOR_STATUS", "vendor_status", 1), ("VENDOR_STATUS", "vendorstatus", 2), ("BLOCK_ID", "block_id", 1), ("BLOCK_ID", "blockid", 2),
    ("UNIT_RATE", "unit_rate", 1), ("UNIT_RATE", "unitrate", 2),
)
CTE["spelt"] = "SELECT * FROM (VALUES " + ", ".join(f"({_q(n)}, {_q(s)}, {k})" for n, s, k in _SPELT) + ") AS t(name, spelling, rank)"


def _line_table(hr: str) -> str:
    cols = ", ".join(f"arg_max(b.value, b.col_idx) FILTER (WHERE hd.name = {_q(n)}) AS {n}" for n in _LC)
    return f"""
    SELECT b.message_id, b.row_idx, {cols}
    FROM (SELECT c.message_id, c.row_idx, c.col_idx, c.value FROM invoice_cells c JOIN {hr} h
            ON c.message_id = h.message_id AND c.row_idx > h.header_row WHERE trim(c.value) <> '') b
    JOIN (SELECT c.message_id, s.name, arg_max(c.col_idx, (-s.rank, c.col_idx)) AS col_idx FROM invoice_cells c JOIN {hr} h
            ON c.message_id = h.message_id AND c.row_idx = h.header_row
          JOIN spelt s ON s.spelling = replace({_norm_label('c.value')}, ' ', '_')
          GROUP BY c.message_id, s.name) hd
      ON b.message_id = hd.message_id AND b.col_idx = hd.col_idx
    GROUP BY b.message_id, b.row_idx"""


CTE["g_lines1"] = _line_table("g_hr1")
CTE["g_lines2"] = _line_table("g_hr2")
_ir, _iid = _run("invoices")
_INV_LINEAGE = f"{_ir} AS run_date, {_iid} AS run_id, 'ARIBA_EMAIL_EXPORT' AS source_system"
CTE["inv_hdr"] = f"""
    SELECT a.message_id, e.supplier, e.supplier_invoice_number, e.invoice_reconciliation, e.on_behalf_of_preparer,
           e.company_code, e.currency, e.total_amount AS ariba_total_amount, e.invoice_date AS ariba_invoice_date,
           k.cwa_number, k.purchase_order_number, k.change_order_number, k.payment_terms, k.invoice_number_excel,
           k.invoice_date_excel, k.due_date_excel, k.total_qty_structures, k.invoice_total_excel_amount,
           coalesce(k.invoice_number_excel, e.supplier_invoice_number) AS invoice_number,
           coalesce(k.invoice_date_excel, e.invoice_date) AS invoice_date,
           a.attachment_file, x.html_file AS email_html_file, {_INV_LINEAGE}
    FROM att_idx a JOIN em_idx x ON a.message_id = x.message_id
    LEFT JOIN g_kv1 k ON a.message_id = k.message_id
    LEFT JOIN em_v1 e ON a.message_id = e.message_id"""
CTE["inv_lines1"] = f"""
    SELECT * FROM (
        SELECT l.message_id, h.invoice_number, h.supplier, trim(l.FLOC_ID) AS floc_id, trim(l.SCE_STRUCT) AS sce_struct,
               trim(l.PHOTO_LOC) AS photo_loc, {_iso_date('l.FLIGHT_DATE')} AS flight_date,
               {_iso_date('l.UPLOAD_DATE')} AS upload_date, trim(l.VENDOR_STATUS) AS vendor_status,
               trim(l.BLOCK_ID) AS block_id, {_num('l.UNIT_RATE')} AS unit_rate,
               row_number() OVER (PARTITION BY l.message_id ORDER BY l.row_idx) AS line_number,
               h.attachment_file, h.email_html_file, {_INV_LINEAGE}
        FROM g_lines1 l JOIN inv_hdr h ON l.message_id = h.message_id)
    WHERE floc_id IS NOT NULL AND floc_id <> ''"""
CTE["canon2"] = """
    SELECT message_id, row_idx, floc_id, sce_struct, folder, flight_date, upload_date, vendor_status, block_id, unit_rate,
           scope_id, starts_with(coalesce(floc_id, ''), 'OH-') AS floc_is_valid_oh, key AS scope_floc_key,
           regexp_matches(coalesce(key, ''), '^\\w+\\|OH-') AS scope_floc_key_is_valid
    FROM (SELECT *, CASE WHEN coalesce(scope_id, '') <> '' AND coalesce(floc_id, '') <> ''
                         THEN coalesce(scope_id, '') || '|' || coalesce(floc_id, '') END AS key
          FROM (SELECT message_id, row_idx, trim(FLOC_ID) AS floc_id, trim(SCE_STRUCT) AS sce_struct,
                       trim(PHOTO_LOC) AS folder, trim(FLIGHT_DATE) AS flight_date, trim(UPLOAD_DATE) AS upload_date,
                       trim(VENDOR_STATUS) AS vendor_status, trim(BLOCK_ID) AS block_id, trim(UNIT_RATE) AS unit_rate,
                       nullif(regexp_extract(trim(BLOCK_ID), '^([A-Z][0-9]{4})-', 1), '') AS scope_id
                FROM g_lines2))
    WHERE coalesce(floc_id, '') <> ''"""
CTE["manifest2"] = f"""
    SELECT a.message_id, a.attachment_file, x.html_file, a.invoice_name_from_attachment, {_INV_LINEAGE},
           CASE WHEN b.bad_floc_sample IS NOT NULL THEN 'FAILED_VALIDATION_BAD_FLOC'
                WHEN a.message_id NOT IN (SELECT message_id FROM canon2) THEN 'FAILED_VALIDATION_NO_LINES' ELSE 'PARSED_OK' END AS status,
           b.bad_floc_sample
    FROM att_idx a JOIN em_idx x ON a.message_id = x.message_id
    LEFT JOIN (SELECT message_id, string_agg(floc_id, ';' ORDER BY row_idx) AS bad_floc_sample
               FROM (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY row_idx) AS rn
                     FROM canon2 WHERE NOT coalesce(floc_is_valid_oh, FALSE))
               WHERE rn <= 5 GROUP BY message_id) b ON a.message_id = b.message_id"""

_FINAL.update({
    "html_fields": f"""
        SELECT page_id, url, {_tag('html', 'title')} AS title, {_tag('html', 'h1')} AS h1,
               len(lines) AS n_lines, lines[1] AS first_line
        FROM (SELECT *, {_lines('html')} AS lines FROM html_pages, refs)""",
    "html_lines": f"""
        SELECT page_id, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS line_no, unnest(lines) AS line
        FROM (SELECT page_id, {_lines('html')} AS lines FROM html_pages, refs)""",
    "invoice_email_fields": "SELECT * FROM em_v2",
    "grid_header_row": "SELECT * FROM g_hr1",
    "grid_header_row_v2": "SELECT * FROM g_hr2",
    "grid_header_kv": "SELECT * FROM g_kv1",
    "grid_header_kv_v2": "SELECT * FROM g_kv2",
    "grid_lines": "SELECT * FROM g_lines1",
    "invoice_header": "SELECT * FROM inv_hdr",
    "invoice_lines_v1": "SELECT * FROM inv_lines1",
    "invoice_lines_v2": f"""
        SELECT c.* EXCLUDE (row_idx), e.supplier, e.supplier_invoice_number, {_INV_LINEAGE},
               row_number() OVER (PARTITION BY c.message_id ORDER BY c.row_idx) AS line_number
        FROM canon2 c
        JOIN (SELECT message_id FROM manifest2 WHERE status = 'PARSED_OK') ok ON c.message_id = ok.message_id
        LEFT JOIN em_v2 e ON c.message_id = e.message_id""",
    "file_manifest_status": "SELECT * FROM manifest2",
    "invoice_orphans": """
        SELECT message_id, 'ATTACHMENT_WITHOUT_HTML' AS orphan_kind, attachment_file AS file_name
        FROM att_idx a WHERE NOT EXISTS (SELECT 1 FROM em_idx x WHERE x.message_id = a.message_id)
        UNION ALL
        SELECT message_id, 'HTML_WITHOUT_ATTACHMENT', html_file
        FROM em_idx x WHERE NOT EXISTS (SELECT 1 FROM att_idx a WHERE a.message_id = x.message_id)""",
})


# --- quality, ledgers, snapshots, history ---------------------------------------------

_sh = _run("scope_master")
_FINAL.update({
    "contract_report": """
        SELECT * FROM (VALUES
            ('release_distribution', 'required', 'FLOC', TRUE, CAST(NULL AS VARCHAR)),
            ('release_distribution', 'required', 'SCOPE_ID', TRUE, NULL),
            ('release_distribution', 'required', 'VENDOR', TRUE, NULL),
            ('release_distribution', 'any_of_regex', 'removal', TRUE, 'SCOPE_REMOVAL_DATE'),
            ('release_distribution', 'any_of_regex', '^scope package', FALSE, NULL),
            ('release_distribution', 'not_all_null', 'EXTRA_COLUMN', FALSE, 'column missing')
        ) AS t(name, "check", target, ok, detail)
        UNION ALL
        SELECT 'release_distribution', 'not_all_null', c, n > 0, 'non-null values: ' || CAST(n AS VARCHAR)
        FROM (SELECT count(FLOC) AS a, count(SCOPE_ID) AS b, count(SCOPE_REMOVAL_DATE) AS d FROM release_dist_raw) x,
             (VALUES ('FLOC'), ('SCOPE_ID'), ('SCOPE_REMOVAL_DATE')) AS v(c),
             LATERAL (SELECT CASE c WHEN 'FLOC' THEN x.a WHEN 'SCOPE_ID' THEN x.b ELSE x.d END AS n)""",
    "duplicate_keys_top10": """
        SELECT scope_floc_key, count(*) AS count FROM rel_dist GROUP BY scope_floc_key HAVING count(*) > 1
        ORDER BY count DESC, scope_floc_key ASC NULLS FIRST LIMIT 10""",
    "vendor_domain": """
        SELECT b.value, array_to_string(list_sort(list_distinct(list(h.hint) FILTER (WHERE h.hint IS NOT NULL))), ';') AS did_you_mean
        FROM (SELECT DISTINCT vendor AS value FROM deliveries_raw
              WHERE vendor NOT IN ('V0', 'V1', 'V2', 'v3-legacy')) b
        LEFT JOIN (SELECT lower(substr(v, 1, 2)) AS p, v AS hint FROM (VALUES ('V0'), ('V1'), ('V2'), ('v3-legacy')) AS t(v)) h
          ON lower(substr(b.value, 1, 2)) = h.p
        GROUP BY b.value""",
    "null_rates": """
        SELECT c AS "column", n AS rows, k AS nulls, CASE WHEN n > 0 THEN CAST(k AS DOUBLE) / n ELSE 0.0 END AS null_rate
        FROM (SELECT count(*) AS n,
                     count(*) FILTER (WHERE object_type IS NULL) AS k1, count(*) FILTER (WHERE voltage IS NULL) AS k2,
                     count(*) FILTER (WHERE assignment_status IS NULL) AS k3, count(*) FILTER (WHERE has_any_mdoc IS NULL) AS k4
              FROM elig_v2) x,
             LATERAL (VALUES ('object_type', x.k1), ('voltage', x.k2), ('assignment_status', x.k3), ('has_any_mdoc', x.k4)) AS v(c, k)""",
    "vendor_row_counts": "SELECT vendor, count(*) AS row_count FROM dl GROUP BY vendor",
    "keep_last_per_message": """
        SELECT message_id, invoice_number, total_amount, status, load_seq FROM (
            SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY load_seq DESC NULLS LAST, src DESC,
                                         invoice_number, total_amount, status) AS rn
            FROM (SELECT *, 0 AS src FROM invoice_load_1 UNION ALL SELECT *, 1 AS src FROM invoice_load_2))
        WHERE rn = 1""",
    "ledger_upsert": """
        SELECT coalesce(b.file_hash, u.file_hash) AS file_hash, b.path,
               CASE WHEN u.file_hash IS NOT NULL THEN u.status ELSE b.status END AS status, u.line_count
        FROM file_ledger b FULL OUTER JOIN file_ledger_updates u ON b.file_hash = u.file_hash""",
    "not_yet_loaded": """
        SELECT * FROM incoming_files i
        WHERE NOT EXISTS (SELECT 1 FROM file_ledger l WHERE l.status = 'LOADED' AND l.file_hash = i.file_hash)""",
    "run_latest_state": """
        SELECT run_id, arg_max(status, (event_ts, status)) AS status, min(event_ts) AS started_at,
               max(event_ts) AS last_event_at, count(*) AS event_count
        FROM run_ledger GROUP BY run_id""",
    "schema_conform": f"""
        SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey AS nation_id, s_acctbal AS account_balance,
               CAST(NULL AS VARCHAR) AS region, {_sh[0]} AS run_date, {_sh[1]} AS run_id, 'supplier.parquet' AS source_file_saved
        FROM supplier""",
    "preview": "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_partkey LIMIT 200",
    "profile": """
        SELECT c AS "column", t AS dtype, n AS rows, k AS nulls, d AS distinct_values
        FROM (SELECT count(*) AS n,
                     count(*) FILTER (WHERE p_partkey IS NULL) AS k1, count(DISTINCT p_partkey) AS d1,
                     count(*) FILTER (WHERE p_name IS NULL) AS k2, count(DISTINCT p_name) AS d2,
                     count(*) FILTER (WHERE p_brand IS NULL) AS k3, count(DISTINCT p_brand) AS d3,
                     count(*) FILTER (WHERE p_type IS NULL) AS k4, count(DISTINCT p_type) AS d4,
                     count(*) FILTER (WHERE p_size IS NULL) AS k5, count(DISTINCT p_size) AS d5,
                     count(*) FILTER (WHERE p_retailprice IS NULL) AS k6, count(DISTINCT p_retailprice) AS d6
              FROM part) x,
             LATERAL (VALUES ('p_partkey', 'bigint', x.k1, x.d1), ('p_name', 'string', x.k2, x.d2),
                             ('p_brand', 'string', x.k3, x.d3), ('p_type', 'string', x.k4, x.d4),
                             ('p_size', 'int', x.k5, x.d5), ('p_retailprice', 'double', x.k6, x.d6)) AS v(c, t, k, d)""",
})

CTE["snap_v2"] = "SELECT *, 'snap-2026-02-02' AS snapshot_id, TIMESTAMP '2026-02-02 06:00:00' AS as_of_ts, 'v2' AS rule_version FROM elig_v2"
CTE["snap_v1"] = "SELECT *, 'snap-2026-02-01' AS snapshot_id, TIMESTAMP '2026-02-01 06:00:00' AS as_of_ts, 'v1' AS rule_version FROM elig_v1"
CTE["inv_flags"] = """
    SELECT vendor, scope_floc_key, TRUE AS invoiced_flg, bool_or(coalesce(paid_flg, FALSE)) AS paid_flg,
           count(DISTINCT invoice_id) AS invoice_count
    FROM invoice_line_fact GROUP BY vendor, scope_floc_key"""
CTE["snap_registry"] = """
    SELECT * FROM (VALUES ('snap-2026-02-01', TIMESTAMP '2026-02-01 06:00:00', 'v1'), ('snap-2026-02-02', TIMESTAMP '2026-02-02 06:00:00', 'v2'))
        AS t(snapshot_id, as_of_ts, rule_version)"""
CTE["ledger_cur"] = """
    SELECT s.*, coalesce(f.invoiced_flg, FALSE) AS invoiced_flg, coalesce(f.paid_flg, FALSE) AS paid_flg,
           CAST(coalesce(f.invoice_count, 0) AS BIGINT) AS invoice_count,
           coalesce(s.approved_to_invoice, FALSE) AS ready_to_invoice_flg
    FROM (SELECT * FROM snap_v2 WHERE snapshot_id = (SELECT arg_max(snapshot_id, as_of_ts) FROM snap_registry)) s
    LEFT JOIN inv_flags f ON s.vendor = f.vendor AND s.scope_floc_key = f.scope_floc_key"""
CTE["asg_rel"] = "SELECT DISTINCT vendor, effective_ts AS ts FROM release_history"
CTE["asg_listed"] = "SELECT DISTINCT vendor, floc, scope_id, effective_ts AS ts FROM release_history"
CTE["asg_marked"] = """
    SELECT l.*, (SELECT max(r.ts) FROM asg_rel r WHERE r.vendor = l.vendor AND r.ts < l.ts) AS before_ts,
           (SELECT min(r.ts) FROM asg_rel r WHERE r.vendor = l.vendor AND r.ts > l.ts) AS after_ts
    FROM asg_listed l"""
CTE["asg_begin"] = """
    SELECT m.* FROM asg_marked m
    ANTI JOIN asg_listed b ON b.vendor = m.vendor AND b.floc = m.floc AND b.scope_id = m.scope_id AND b.ts = m.before_ts"""
CTE["asg_end"] = """
    SELECT m.* FROM asg_marked m
    ANTI JOIN asg_listed a ON a.vendor = m.vendor AND a.floc = m.floc AND a.scope_id = m.scope_id AND a.ts = m.after_ts"""
CTE["asg_hist"] = """
    SELECT b.vendor, b.floc, b.scope_id, b.ts AS effective_start_ts, e.after_ts AS effective_end_ts,
           (SELECT count(*) FROM asg_rel r WHERE r.vendor = b.vendor AND r.ts BETWEEN b.ts AND e.ts) AS release_count,
           e.after_ts IS NULL AS is_current
    FROM asg_begin b
    ASOF JOIN (SELECT * FROM asg_end) e ON e.vendor = b.vendor AND e.floc = b.floc AND e.scope_id = b.scope_id AND e.ts >= b.ts"""
CTE["cert_versions"] = """
    SELECT *, row_number() OVER (PARTITION BY invoice_number ORDER BY loaded_at DESC NULLS LAST, message_id DESC) AS version_rank
    FROM invoice_versions"""

_FINAL.update({
    "eligibility_snapshot": "SELECT * FROM snap_v2",
    "snapshot_summary": """
        SELECT snapshot_id, as_of_ts, rule_version, asset_class, vendor, scope_id, floc_count, approved_count,
               floc_count - approved_count AS blocked_count,
               CASE WHEN floc_count > 0 THEN CAST(approved_count AS DOUBLE) / floc_count ELSE 0.0 END AS approved_rate
        FROM (SELECT snapshot_id, as_of_ts, rule_version, asset_class, vendor, scope_id, count(scope_floc_key) AS floc_count,
                     count(*) FILTER (WHERE coalesce(approved_to_invoice, FALSE)) AS approved_count
              FROM snap_v2 GROUP BY ALL)""",
    "ledger_current": "SELECT * FROM ledger_cur",
    "approved_to_invoice": "SELECT * FROM ledger_cur WHERE ready_to_invoice_flg AND NOT invoiced_flg",
    "blocked_items": "SELECT * FROM ledger_cur WHERE NOT ready_to_invoice_flg AND NOT invoiced_flg",
    "invoiced_paid": """
        SELECT *, CASE WHEN paid_flg THEN 'PAID' ELSE 'INVOICED_UNPAID' END AS payment_state
        FROM ledger_cur WHERE invoiced_flg""",
    "snapshot_registry": """
        SELECT r.*, CASE rule_version WHEN 'v1' THEN (SELECT count(*) FROM elig_v1) ELSE (SELECT count(*) FROM elig_v2) END AS line_rows
        FROM snap_registry r""",
    "snapshot_as_of": "SELECT * FROM snap_v1",
    "invoice_flags": "SELECT * FROM inv_flags",
    "vendor_export": """
        SELECT vendor, scope_floc_key, snapshot_id, CAST(invoice_count AS VARCHAR) AS invoice_count,
               '2026-02-02' AS run_date, 'exp-0001' AS run_id
        FROM ledger_cur WHERE ready_to_invoice_flg AND NOT invoiced_flg""",
    # An assignment is in effect from a release that lists it and that follows no release listing it, to the first later
    # release of the vendor that does not.
    "assignment_history": "SELECT * FROM asg_hist",
    "assignment_conflicts": """
        SELECT p.floc, p.pt AS conflict_start_ts, p.until AS conflict_end_ts, count(*) AS n_assignments,
               string_agg(h.vendor || '/' || h.scope_id, ';' ORDER BY h.vendor || '/' || h.scope_id) AS assignments
        FROM (SELECT floc, pt, lead(pt) OVER (PARTITION BY floc ORDER BY pt) AS until
              FROM (SELECT floc, effective_start_ts AS pt FROM asg_hist
                    UNION SELECT floc, effective_end_ts FROM asg_hist WHERE effective_end_ts IS NOT NULL)) p
        JOIN asg_hist h ON h.floc = p.floc AND h.effective_start_ts <= p.pt AND (h.effective_end_ts IS NULL OR h.effective_end_ts > p.pt)
        GROUP BY p.floc, p.pt, p.until HAVING count(*) > 1""",
    "certified_invoice_versions": "SELECT * EXCLUDE (version_rank), version_rank = 1 AS is_effective FROM cert_versions",
    "certified_invoice_current": "SELECT * EXCLUDE (version_rank), TRUE AS is_effective FROM cert_versions WHERE version_rank = 1",
    "certified_invoice_lines": """
        SELECT * FROM invoice_version_lines l
        WHERE l.message_id IN (SELECT message_id FROM cert_versions WHERE version_rank = 1)""",
})


# --- publishing round trips, CSV sources, the drop stream ----------------------------------

_FINAL.update({
    "publish_roundtrip_current": "SELECT * FROM rel_dist",
    "publish_roundtrip_history": """
        SELECT vendor, r.run_date, r.run_id, count(*) AS row_count, count(*) FILTER (WHERE is_active) AS active_count
        FROM rel_dist, (VALUES ('2026-01-10', 'r1'), ('2026-01-12', 'r2'), ('2026-01-15', 'r3')) AS r(run_date, run_id)
        GROUP BY vendor, r.run_date, r.run_id""",
    "previous_run_rows": """
        SELECT * EXCLUDE (run_date, run_id, source_sheet), 'r2' AS source_sheet, '2026-01-12' AS run_date, 'r2' AS run_id
        FROM rel_dist""",
    "dynamic_overwrite": """
        SELECT * EXCLUDE (source_sheet), CASE WHEN vendor = 'V0' THEN 'Distribution-v2' ELSE source_sheet END AS source_sheet
        FROM rel_dist""",
    "csv_strings_roundtrip": """
        SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey,
               CASE WHEN n_regionkey IN (0, 1) THEN '' ELSE n_name END AS n_name,
               CAST(n_regionkey AS VARCHAR) AS n_regionkey
        FROM nation""",
    "csv_sniffed": """
        SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation""",
    "csv_mixed_dialects": """
        SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, 'a "q",; ' || n_name || chr(10) || '  second line' AS note,
               CASE WHEN n_regionkey >= 2 THEN CAST(n_regionkey AS VARCHAR) END AS n_regionkey
        FROM nation""",
    "events_stream_latest": """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id, event_type, value, props) AS rn
            FROM events)
        WHERE rn = 1""",
})


_FINAL.update({
    "file_manifest_v1": """
        SELECT a.attachment_file AS attachment, a.message_id,
               CASE WHEN x.message_id IS NULL THEN 'SKIPPED_NO_HTML' WHEN h.message_id IS NULL THEN 'SKIPPED_BAD_FORMAT' ELSE 'OK' END AS status,
               CASE WHEN x.message_id IS NOT NULL AND h.message_id IS NOT NULL THEN CAST(coalesce(c.lines, 0) AS BIGINT) END AS lines,
               CASE WHEN x.message_id IS NOT NULL AND h.message_id IS NOT NULL THEN c.supplier END AS supplier
        FROM att_idx a
        LEFT JOIN em_idx x ON a.message_id = x.message_id
        LEFT JOIN g_hr1 h ON a.message_id = h.message_id
        LEFT JOIN (SELECT message_id, count(*) AS lines, max(supplier) AS supplier FROM inv_lines1 GROUP BY message_id) c
          ON a.message_id = c.message_id""",
})


_FINAL.update({
    "release_load_header": f"""
        SELECT 'scope_release_distribution' AS dataset, CAST(NULL AS VARCHAR) AS vendor, {_run("release_dist")[0]} AS run_date,
               {_run("release_dist")[1]} AS run_id, r.n AS raw_rows, 3 AS raw_cols, s.n AS silver_rows
        FROM (SELECT count(*) AS n FROM release_dist_raw) r, (SELECT count(*) AS n FROM rel_dist) s""",
    "canonical_keys": "SELECT _floc AS floc, _scope_id AS scope_id, _removal_dt AS scope_removal_date, CAST(NULL AS BIGINT) AS visit_no FROM snap_cur",
})


def _trans_keyed(raw: str) -> str:
    sig = "sha256(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in ("AMOUNT", "Date_Removed", "FLOC")) + "))"
    return f"""
    SELECT *, _removal_dt IS NULL AS _is_active, _scope_id || '|' || _floc AS _key, {sig} AS _sig FROM (
        SELECT FLOC, Date_Removed, AMOUNT, trim(s) AS _scope_id, CAST(n AS BIGINT) AS _visit_no, trim(FLOC) AS _floc,
               {_ts(_lit_nulls('Date_Removed'))} AS _removal_dt
        FROM (SELECT *, pkg_1 AS s, 1 AS n FROM {raw} UNION ALL SELECT *, pkg_2 AS s, 2 AS n FROM {raw}))
    WHERE _scope_id IS NOT NULL AND _scope_id <> ''"""


CTE["tsnap_prev"] = _trans_keyed("snapshot_trans_prev_raw")
CTE["tsnap_cur"] = _trans_keyed("snapshot_trans_cur_raw")
_TCOLS = ("_key", "FLOC", "Date_Removed", "AMOUNT", "_visit_no", "_is_active")
CTE["tsnap_delta"] = f"""
    SELECT CASE WHEN dt IN ('added_new', 'reactivated') THEN 'ADDED'
                WHEN dt IN ('removed_soft', 'removed_missing_in_current') THEN 'REMOVED' ELSE 'UPDATED' END AS change_set,
           dt AS _delta_type,
           {", ".join(f"CASE WHEN dt = 'removed_missing_in_current' THEN p_{c} ELSE c_{c} END AS {c}" for c in _TCOLS)}
    FROM (
        SELECT *,
               CASE WHEN c_in AND NOT p_in AND c__is_active THEN 'added_new'
                    WHEN c_in AND p_in AND NOT p__is_active AND c__is_active THEN 'reactivated'
                    WHEN c_in AND p_in AND p__is_active AND NOT c__is_active THEN 'removed_soft'
                    WHEN NOT c_in AND p_in AND p__is_active THEN 'removed_missing_in_current'
                    WHEN c_in AND p_in AND p__is_active AND c__is_active AND c__sig <> p__sig THEN 'updated_active'
               END AS dt
        FROM (SELECT coalesce(c.c_in, FALSE) AS c_in, coalesce(p.p_in, FALSE) AS p_in, c.*, p.*
              FROM (SELECT TRUE AS c_in, {", ".join(f"{c} AS c_{c}" for c in (*_TCOLS, "_sig"))} FROM tsnap_cur) c
              FULL OUTER JOIN (SELECT TRUE AS p_in, {", ".join(f"{c} AS p_{c}" for c in (*_TCOLS, "_sig"))} FROM tsnap_prev) p
              ON c.c__key IS NOT DISTINCT FROM p.p__key))
    WHERE dt IS NOT NULL"""
_FINAL["snapshot_delta_transmission"] = "SELECT * FROM tsnap_delta"

# --- readers, publishing and jobs ---------------------------------------------------

_CONTRACT = """
        SELECT {name} AS name, k AS "check", t AS target, ok, d AS detail FROM (VALUES {static}) AS s(k, t, ok, d)
        UNION ALL SELECT {name}, 'not_all_null', c, n > 0, 'non-null values: ' || CAST(n AS VARCHAR)
        FROM (SELECT {counts} FROM {raw}) x, LATERAL (VALUES {stack}) AS v(c, n)"""


def _contract_sql(name: str, raw: str, required: tuple[str, ...], slots: str | None, filled: tuple[str, ...]) -> str:
    static = [f"('required', {_q(c)}, TRUE, CAST(NULL AS VARCHAR))" for c in required]
    if slots:
        static.append(f"('any_of_regex', '^Scope Package\\s*#\\s*\\d+\\s*$', TRUE, {_q(slots)})")
    return _CONTRACT.format(
        name=_q(name), raw=raw, static=", ".join(static), counts=", ".join(f"count({c}) AS n{i}" for i, c in enumerate(filled)),
        stack=", ".join(f"({_q(c)}, x.n{i})" for i, c in enumerate(filled)),
    )


_SLOTS = "Scope Package #1;Scope Package #2"
_FINAL.update({
    "optional_read": "SELECT * FROM supplier",
    "schema_misfits": """
        SELECT "column", dtype, misfits
        FROM (SELECT count(*) FILTER (WHERE createdAt LIKE '%/%') AS a, count(*) FILTER (WHERE readyToSync = 'maybe') AS b FROM survey_raw) x,
             LATERAL (VALUES ('createdAt', 'timestamp_ntz', x.a), ('readyToSync', 'boolean', x.b), ('src_pos', 'int', 0)) AS t("column", dtype, misfits)""",
    "newest_drop": """
        SELECT * FROM drop_listing WHERE file_name LIKE 'azure%'
        ORDER BY regexp_extract(file_name, '_([0-9]{8}_[0-9]{6})Z', 1) DESC, file_name DESC LIMIT 1""",
    "whole_documents": "SELECT url || chr(10) AS text FROM pages",
    "archive_receipts": "SELECT strlen(url) + 1 AS length, sha256(url || chr(10)) AS file_hash, '2026-02-04' AS run_date, 'arc-0001' AS run_id FROM pages",
    "publish_whole_roundtrip": """
        SELECT s_suppkey, s_name, '2026-02-01' AS run_date, 'r1' AS run_id, 'HISTORY' AS version FROM supplier
        UNION ALL SELECT s_suppkey, s_name, '2026-02-02', 'r2', v FROM supplier, (VALUES ('HISTORY'), ('CURRENT')) AS t(v) WHERE s_suppkey % 2 = 0""",
    "vendor_history": """
        SELECT vendor, event_type, 'r1' AS run_id, count(*) AS row_count FROM ev_all WHERE vendor IN ('V0', 'V2') GROUP BY vendor, event_type""",
    "publish_rerun_history": """
        SELECT version, vendor, run_id, count(*) AS row_count
        FROM rel_dist r, (VALUES ('HISTORY', 'r1'), ('HISTORY', 'r2'), ('CURRENT', 'r1'), ('CURRENT', 'r2')) AS t(version, rid)
        , LATERAL (SELECT t.rid AS run_id) x
        WHERE CASE WHEN t.version = 'HISTORY' THEN t.rid = 'r1' OR r.vendor <> 'V1' ELSE (t.rid = 'r1') = (r.vendor = 'V1') END
        GROUP BY ALL""".replace("SELECT version, vendor, run_id,", "SELECT t.version, r.vendor, x.run_id,"),
    "delta_history": "SELECT 'V9' AS vendor, change_set, _delta_type, count(*) AS row_count FROM snap_delta GROUP BY change_set, _delta_type",
    "transmission_scope_fallback": """
        SELECT trim(SCOPE_ID) || '|' || trim(FLOC) AS _key, trim(FLOC) AS _floc, trim(SCOPE_ID) AS _scope_id, CAST(NULL AS BIGINT) AS _visit_no, TRUE AS _is_active
        FROM helo_trans_raw WHERE trim(SCOPE_ID) <> ''""",
    "transmission_keys_by_visit": "SELECT _scope_id || '|' || _floc || '|' || CAST(_visit_no AS VARCHAR) AS _key, _visit_no, _is_active FROM tsnap_cur",
    "event_contracts": " UNION ALL ".join((
        _contract_sql("removal_distribution", "events_removal_dist_raw", ("FLOC", "SCOPE_ID"), None, ("FLOC",)),
        _contract_sql("removal_transmission", "events_removal_trans_raw", ("FLOC",), _SLOTS, ("FLOC",)),
        _contract_sql("move_distribution", "events_move_dist_raw", ("FLOC", "SCOPE_ID"), None, ("FLOC", "SCOPE_ID")),
        _contract_sql("move_transmission", "events_move_trans_raw", ("FLOC",), _SLOTS, ("FLOC",)),
    )),
    "deliveries_agg_raw_names": "SELECT * EXCLUDE (asset_class) FROM dagg WHERE asset_class = 'distribution'",
    "eligibility_defaults": f"""
        SELECT 'transmission' AS asset_class, 'TRANS' AS program_bucket, 'ATI' AS program_acronym, 'ATI' AS billing_bucket,
               img >= {MIN_IMAGES} AS is_work_complete, TRUE AS is_billable, vendor, scope_id, floc, scope_floc_key,
               CAST(NULL AS VARCHAR) AS object_type, CAST(NULL AS VARCHAR) AS voltage, assignment_method, '' AS assignment_status,
               TRUE AS is_active_assignment, img AS image_count_total, fc AS folder_count, img >= {MIN_IMAGES} AS approved_to_invoice,
               CASE WHEN img < {MIN_IMAGES} THEN 'BLOCK_MISSING_GCP_MIN_IMAGES' ELSE '' END AS block_reasons,
               img < {MIN_IMAGES} AS needs_review, {_ELIG_LINEAGE}
        FROM et0_v2""",
    "workbook_events": f"""
        SELECT 'V7' AS vendor, 'Distribution' AS source_sheet, 'wb-0001' AS run_id, count(*) AS row_count, 'Transmission__skipped=missing sheet' AS skipped
        FROM ev_rem WHERE source_sheet = 'Distribution'""",
    "eligibility_job": f"SELECT *, {_ed} AS run_date, {_eid} AS run_id FROM elig_v2",
    "invoice_job_v2": """
        SELECT c.message_id, row_number() OVER (PARTITION BY c.message_id ORDER BY c.row_idx) AS line_number, c.floc_id, c.scope_id, c.unit_rate, e.supplier
        FROM canon2 c JOIN manifest2 m ON m.message_id = c.message_id AND m.status = 'PARSED_OK' LEFT JOIN em_v2 e ON e.message_id = c.message_id""",
    "invoice_job_v1": """
        SELECT message_id, line_number, floc_id, unit_rate, CASE WHEN attachment_file LIKE '%1.xlsx' THEN 'i2' ELSE 'i1' END AS run_id,
               CAST(CASE WHEN attachment_file LIKE '%1.xlsx' THEN 2 ELSE 1 END AS BIGINT) AS load_seq
        FROM inv_lines1""",
})
_FINAL["invoice_upsert_current"] = _FINAL["keep_last_per_message"]
