"""Fixture views: the reference's inputs derived from the driver tables.

The driver ships TPC-H-like tables, not release sheets or evidence exports.
§7.5).  Every view reads its whole source table: rows are *assigned* to a role
(e.g. HELO vs DRONE by return flag), never sampled, so the work grows with the
tables.  Arithmetic such as ``l_suppkey % 4`` only *derives* values (a vendor
code, a scope id); null, blank and malformed values are provoked the same way
because the driver tables hold none.

The text is plain SQL that both Spark SQL and DuckDB accept, so the Spark
queries and the DuckDB oracles start from identical inputs; the operators under
test are written independently on each side.
"""

from __future__ import annotations

_YMD = (
    "CAST(year({c}) AS STRING) || lpad(CAST(month({c}) AS STRING), 2, '0') || "
    "lpad(CAST(day({c}) AS STRING), 2, '0')"
)
_VENDOR = "'V' || CAST(l_suppkey % 4 AS STRING)"
_BRAND_NO = "CAST(substr(p_brand, 7) AS INT)"

_EVENT_COLS = """'V' || CAST(user_id % 4 AS STRING) AS vendor,
               'FL-' || CAST((user_id * 37) % 2000 AS STRING) AS FLOC,
               CAST(CAST(ts AS DATE) AS STRING) AS run_date,
               'e' || lpad(CAST(event_id AS STRING), 7, '0') AS run_id"""
_EVENT_SCOPE = "CASE WHEN event_id % 9 = 0 THEN '' ELSE 'D' || CAST(event_id % 20 AS STRING) END AS SCOPE_ID"
_EVENT_SLOTS = """CASE WHEN event_id % 9 = 0 THEN ' ' ELSE 'T' || CAST(event_id % 20 AS STRING) END AS pkg_1,
               CASE WHEN event_id % 5 = 0 THEN 'T' || CAST((event_id + 3) % 20 AS STRING) END AS pkg_2"""
_EVENT_DATE = "CASE WHEN value < 5 THEN 'unknown' ELSE substr(CAST(ts AS STRING), 1, 19) END"

ROLE_SQL: dict[str, str] = {
    # J1 distribution release sheet: one row per lineitem that is not a HELO return.
    "release_dist_raw": f"""
        SELECT {_VENDOR} AS vendor,
               ' FL-' || CAST(l_partkey AS STRING) || ' ' AS FLOC,
               CASE WHEN l_orderkey % 11 = 0 THEN '  ' ELSE 'D' || CAST(l_orderkey % 20 AS STRING) END AS SCOPE_ID,
               CASE WHEN l_linestatus = 'F' AND l_linenumber = 2 THEN 'not a date'
                    WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) AS STRING) END AS SCOPE_REMOVAL_DATE
        FROM lineitem WHERE l_returnflag <> 'R' AND l_linenumber <= 5""",
    # J1 transmission release sheet with three package slots (renamed to
    # "Scope Package #N" variants on the Spark side).
    "release_trans_raw": f"""
        SELECT {_VENDOR} AS vendor,
               'FL-' || CAST(l_partkey AS STRING) AS FLOC,
               CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) AS STRING) END AS Date_Removed,
               'T' || CAST(l_orderkey % 20 AS STRING) AS pkg_1,
               CASE WHEN l_quantity > 25 THEN 'T' || CAST((l_orderkey + 7) % 20 AS STRING) ELSE ' ' END AS pkg_2,
               CASE WHEN l_discount > 0.05 THEN 'T' || CAST((l_orderkey + 3) % 20 AS STRING) END AS pkg_3
        FROM lineitem WHERE l_returnflag <> 'R' AND l_linenumber > 5""",
    # J3 HELO trackers: the returned lineitems.
    "helo_dist_raw": f"""
        SELECT {_VENDOR} AS vendor,
               'FL-' || CAST(l_partkey AS STRING) AS FLOC,
               CASE WHEN l_orderkey % 11 = 0 THEN ' ' ELSE 'D' || CAST(l_orderkey % 20 AS STRING) END AS SCOPE_ID
        FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber <= 5""",
    "helo_trans_raw": f"""
        SELECT {_VENDOR} AS vendor,
               'FL-' || CAST(l_partkey AS STRING) AS FLOC,
               'T' || CAST(l_orderkey % 20 AS STRING) AS SCOPE_ID
        FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber > 5""",
    # J1 and J3 sheets of both classes as one table, class and method as columns: what the four views above hold.
    "assignment_sheets_raw": f"""
        SELECT CASE WHEN l_linenumber <= 5 THEN 'Distribution' ELSE 'Transmission' END AS asset_class,
               CASE WHEN l_returnflag = 'R' THEN 'HELO' ELSE 'DRONE' END AS assignment_method,
               {_VENDOR} AS vendor,
               ' FL-' || CAST(l_partkey AS STRING) || ' ' AS FLOC,
               CASE WHEN l_linenumber > 5 AND l_returnflag = 'R' THEN 'T' || CAST(l_orderkey % 20 AS STRING)
                    WHEN l_linenumber > 5 THEN NULL
                    WHEN l_orderkey % 11 = 0 THEN '  ' ELSE 'D' || CAST(l_orderkey % 20 AS STRING) END AS SCOPE_ID,
               CASE WHEN l_linestatus = 'F' AND l_linenumber = 2 THEN 'not a date'
                    WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) AS STRING) END AS SCOPE_REMOVAL_DATE,
               CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) AS STRING) END AS Date_Removed,
               'T' || CAST(l_orderkey % 20 AS STRING) AS pkg_1,
               CASE WHEN l_quantity > 25 THEN 'T' || CAST((l_orderkey + 7) % 20 AS STRING) ELSE ' ' END AS pkg_2,
               CASE WHEN l_discount > 0.05 THEN 'T' || CAST((l_orderkey + 3) % 20 AS STRING) END AS pkg_3
        FROM lineitem""",
    # J2 event sheets: error events are removals, purchase events moves to HELO, the others events of unknown types; even
    # ids are on transmission sheets, with package slots.  Each event is its own run (run date = event day).
    "events_raw": f"""
        SELECT CASE WHEN event_id % 2 = 0 THEN 'Transmission' ELSE 'Distribution' END AS asset_class,
               CASE event_type WHEN 'error' THEN 'removal' WHEN 'purchase' THEN 'move_to_helo' ELSE event_type END AS event_type,
               {_EVENT_COLS}, {_EVENT_SCOPE}, {_EVENT_SLOTS}, {_EVENT_DATE} AS SCOPE_REMOVAL_DATE, {_EVENT_DATE} AS Date_Removed
        FROM events""",
    "events_removal_dist_raw": f"SELECT {_EVENT_COLS}, {_EVENT_SCOPE}, {_EVENT_DATE} AS SCOPE_REMOVAL_DATE FROM events WHERE event_type = 'error' AND event_id % 2 = 1",
    "events_removal_trans_raw": f"SELECT {_EVENT_COLS}, {_EVENT_SLOTS}, {_EVENT_DATE} AS Date_Removed FROM events WHERE event_type = 'error' AND event_id % 2 = 0",
    "events_move_dist_raw": f"SELECT {_EVENT_COLS}, {_EVENT_SCOPE} FROM events WHERE event_type = 'purchase' AND event_id % 2 = 1",
    "events_move_trans_raw": f"SELECT {_EVENT_COLS}, {_EVENT_SLOTS} FROM events WHERE event_type = 'purchase' AND event_id % 2 = 0",
    # J5 delivery exports (all text): one upload per lineitem.
    "deliveries_raw": f"""
        SELECT CASE WHEN l_tax = 0 THEN '13-45-2001'
                    ELSE CAST(month(l_shipdate) AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(year(l_shipdate) AS STRING) END AS DateUploaded,
               lpad(CAST(month(l_shipdate) AS STRING), 2, '0') || '-' || lpad(CAST(day(l_shipdate) AS STRING), 2, '0') || '-' || CAST(year(l_shipdate) AS STRING) AS flight_date,
               {_VENDOR} AS vendor,
               'FL-' || CAST(l_partkey AS STRING) AS structureId,
               CASE WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN 'nodash_Assets_' || {_YMD.format(c='l_shipdate')}
                    WHEN l_discount = 0.1 THEN (CASE WHEN l_linenumber <= 5 THEN 'D' ELSE 'T' END) || CAST(l_orderkey % 20 AS STRING) || '-' || lpad(CAST(l_orderkey % 1000 AS STRING), 4, '0') || '_Assets_bad'
                    ELSE (CASE WHEN l_linenumber <= 5 THEN 'D' ELSE 'T' END) || CAST(l_orderkey % 20 AS STRING) || '-' || lpad(CAST(l_orderkey % 1000 AS STRING), 4, '0') || '_Assets_' || {_YMD.format(c='l_shipdate')} END AS folder,
               CASE WHEN l_linenumber = 3 AND l_returnflag = 'N' THEN 'x'
                    WHEN l_tax = 0.08 THEN ''
                    ELSE CAST(l_quantity / 3 AS STRING) END AS imageCount,
               CASE WHEN l_linenumber <= 5 THEN 'distribution' ELSE 'transmission' END AS asset_class
        FROM lineitem""",
    # J6 survey export: one inspection per order.
    "survey_raw": """
        SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'null' ELSE 'FL-' || CAST((o_orderkey * 7) % 2300 AS STRING) END AS flocNumber,
               CASE WHEN o_orderkey % 4 = 1 THEN CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/'
                         || CAST(year(o_orderdate) AS STRING) || ' ' || CAST(1 + o_orderkey % 12 AS STRING) || ':24:51'
                         || CASE WHEN o_orderkey % 8 = 1 THEN 'PM' ELSE 'AM' END
                    ELSE CAST(o_orderdate AS STRING) END AS createdAt,
               CASE o_orderstatus WHEN 'F' THEN 'AERIAL' WHEN 'O' THEN 'n/a' ELSE 'AERIAL_' || substr(o_orderpriority, 1, 1) END AS aerialInspectionKind,
               CASE WHEN o_orderstatus = 'F' THEN 'AM' || CAST(o_custkey % 97 AS STRING)
                    WHEN o_orderstatus = 'P' THEN 'N/A' END AS aerialMeasurementDocument,
               substr(o_orderpriority, 3) AS inspectionKind,
               CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2', '3') THEN 'GM' || CAST(o_custkey % 89 AS STRING)
                    ELSE 'none' END AS measurementDocument,
               o_orderstatus AS inspectionStatus,
               CASE o_custkey % 5 WHEN 0 THEN 'ED_POLE' WHEN 1 THEN 'ET_POLE' WHEN 2 THEN 'ET_TOWER' WHEN 3 THEN ' ' ELSE 'EZ_POLE' END AS objectType,
               'WO' || CAST(o_custkey % 300 AS STRING) AS workOrderNumber,
               CASE WHEN o_totalprice > 200000 THEN 'TRUE' WHEN o_totalprice > 100000 THEN 'false' ELSE 'maybe' END AS readyToSync,
               o_orderkey AS src_pos
        FROM orders""",
    # J8 official scope lists, three views of the part table.
    "scope_list_dist_raw": """
        SELECT ' FL-' || CAST(p_partkey AS STRING) AS FLOC,
               CASE p_type WHEN 'ECONOMY' THEN 'ED_POLE' WHEN 'STANDARD' THEN 'ET_POLE' WHEN 'LARGE' THEN 'ET_TOWER'
                           WHEN 'PROMO' THEN 'EZ_POLE' WHEN 'SMALL' THEN 'XX;YY' ELSE ' ' END AS Eq_OjType,
               CASE WHEN p_size % 3 = 0 THEN ' ' ELSE CAST((p_size % 3) * 12 AS STRING) || 'kV' END AS Voltage,
               p_partkey AS src_pos
        FROM part""",
    "scope_list_trans_raw": """
        SELECT 'FL-' || CAST(p_partkey AS STRING) AS FLOC,
               CASE WHEN p_size > 40 THEN 'ET_TOWER' WHEN p_retailprice > 1500 THEN 'ET_POLE' ELSE 'ED_POLE' END AS EqType,
               CAST(p_size AS STRING) || 'kV' AS kV,
               p_partkey AS src_pos
        FROM part WHERE p_size > 25""",
    # The three lists as columns of one table.
    "scope_lists_raw": """
        SELECT ' FL-' || CAST(p_partkey AS STRING) AS FLOC, 'FL-' || CAST(p_partkey AS STRING) AS FLOC_ID,
               CASE p_type WHEN 'ECONOMY' THEN 'ED_POLE' WHEN 'STANDARD' THEN 'ET_POLE' WHEN 'LARGE' THEN 'ET_TOWER'
                           WHEN 'PROMO' THEN 'EZ_POLE' WHEN 'SMALL' THEN 'XX;YY' ELSE ' ' END AS Eq_OjType,
               CASE WHEN p_size % 3 = 0 THEN ' ' ELSE CAST((p_size % 3) * 12 AS STRING) || 'kV' END AS Voltage,
               CASE WHEN p_size > 40 THEN 'ET_TOWER' WHEN p_retailprice > 1500 THEN 'ET_POLE' ELSE 'ED_POLE' END AS EqType,
               CAST(p_size AS STRING) || 'kV' AS kV, 'ED_POLE' AS Eq_ObjType,
               p_size > 25 AS in_trans, p_retailprice > 1800 AS in_comp, p_partkey AS src_pos
        FROM part""",
    "scope_list_comp_raw": """
        SELECT 'FL-' || CAST(p_partkey AS STRING) AS FLOC_ID,
               'ED_POLE' AS Eq_ObjType,
               p_partkey AS src_pos
        FROM part WHERE p_retailprice > 1800""",
    # J9 rate card: one rule per (brand, type) of the part table.
    "rate_card_raw": f"""
        SELECT CASE WHEN {_BRAND_NO} = 25 THEN ' ' ELSE 'V' || CAST({_BRAND_NO} % 4 AS STRING) END AS contractor,
               CASE p_type WHEN 'ECONOMY' THEN 'D360' WHEN 'STANDARD' THEN 'HELO' WHEN 'LARGE' THEN 'ATI'
                           WHEN 'PROMO' THEN 'ODI' WHEN 'SMALL' THEN 'D360' ELSE 'ATI' END AS program,
               CASE {_BRAND_NO} % 3 WHEN 0 THEN NULL WHEN 1 THEN 'ED_POLE' ELSE 'ET_TOWER' END AS object,
               CASE WHEN {_BRAND_NO} % 5 IN (0, 1) THEN NULL
                    ELSE CAST(({_BRAND_NO} % 3) * 12 AS STRING) || 'kV' END AS kv,
               CASE WHEN p_type = 'SMALL' AND {_BRAND_NO} % 2 = 0 THEN NULL ELSE min(p_retailprice) END AS rate,
               min(p_partkey) AS rule_pos
        FROM part GROUP BY p_brand, p_type""",
    # J11 rows to price: every lineitem.
    "price_rows": """
        SELECT CASE WHEN l_suppkey % 29 = 0 THEN NULL ELSE 'V' || CAST(l_suppkey % 4 AS STRING) END AS vendor,
               CASE l_returnflag WHEN 'R' THEN 'HELO' WHEN 'A' THEN 'ATI'
                    ELSE CASE WHEN l_linenumber = 1 THEN 'ODI' ELSE 'D360' END END AS billing_bucket,
               CASE l_partkey % 4 WHEN 0 THEN 'ED_POLE' WHEN 1 THEN 'ET_TOWER' WHEN 2 THEN 'EZ_POLE' END AS object_type,
               CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST((l_linenumber % 3) * 12 AS STRING) || 'kV' END AS voltage,
               l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
        FROM lineitem""",
    # J1 snapshots for the delta: the previous and the current release of the
    # order book, distribution layout.
    "snapshot_prev_raw": """
        SELECT 'FL-' || CAST(o_orderkey AS STRING) AS FLOC,
               CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN ' ' ELSE 'S' || substr(o_orderpriority, 1, 1) END AS SCOPE_ID,
               CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS SCOPE_REMOVAL_DATE,
               o_totalprice AS AMOUNT,
               o_orderstatus AS STATUS
        FROM orders WHERE o_orderdate < DATE '2001-01-01'""",
    "snapshot_cur_raw": """
        SELECT 'FL-' || CAST(o_orderkey AS STRING) AS FLOC,
               CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN 'COMP' ELSE 'S' || substr(o_orderpriority, 1, 1) END AS SCOPE_ID,
               CASE WHEN o_orderstatus = 'O' AND substr(o_orderpriority, 1, 1) = '2' THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
                    WHEN o_orderstatus = 'F' AND substr(o_orderpriority, 1, 1) = '3' THEN NULL
                    WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS SCOPE_REMOVAL_DATE,
               CASE WHEN substr(o_orderpriority, 1, 1) = '4' THEN o_totalprice + 1 ELSE o_totalprice END AS AMOUNT,
               o_orderstatus AS STATUS
        FROM orders WHERE NOT (o_orderstatus = 'P' AND substr(o_orderpriority, 1, 1) = '1')""",
    # J10 invoice sheets as a cells table: a header block, the line-table header
    # and one row per lineitem of the order (message = order).
    "invoice_cells": f"""
        WITH hdr AS (SELECT o_orderkey, 'M' || CAST(o_orderkey AS STRING) AS message_id, 5 + o_orderkey % 3 + CASE WHEN o_orderkey % 23 = 0 THEN 90 ELSE 0 END AS hr,
                            o_orderdate, o_custkey, o_totalprice, o_orderpriority FROM orders),
             body AS (SELECT 'M' || CAST(l_orderkey AS STRING) AS message_id,
                             5 + l_orderkey % 3 + CASE WHEN l_orderkey % 23 = 0 THEN 90 ELSE 0 END + row_number() OVER (PARTITION BY l_orderkey
                                 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS r,
                             l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_discount, l_tax,
                             l_extendedprice, l_shipdate FROM lineitem)
        SELECT message_id, 0 AS row_idx, 0 AS col_idx, 'INVOICE NUMBER' AS value FROM hdr
        UNION ALL SELECT message_id, 0, 2, 'INV-' || CAST(o_orderkey AS STRING) FROM hdr
        UNION ALL SELECT message_id, 1, 0, 'Invoice Date' FROM hdr
        UNION ALL SELECT message_id, 1, 1, CAST(CAST(o_orderdate AS DATE) AS STRING) FROM hdr
        UNION ALL SELECT message_id, 2, 0, 'TOTAL QTY OF STRUCTURES' FROM hdr
        UNION ALL SELECT message_id, 2, 1, 'approx ' || CAST(o_custkey % 50 AS STRING) || ' poles' FROM hdr
        UNION ALL SELECT message_id, 3, 0, 'INVOICE TOTAL' FROM hdr
        UNION ALL SELECT message_id, 3, 1, '$' || CAST(o_totalprice AS STRING) FROM hdr
        UNION ALL SELECT message_id, 4, 0, CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'PO' ELSE 'Payment Terms' END FROM hdr
        UNION ALL SELECT message_id, 4, 1, CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'PO-' || CAST(o_custkey AS STRING) ELSE 'NET' || CAST(o_custkey % 3 * 15 AS STRING) END FROM hdr
        UNION ALL SELECT message_id, hr - 1, 9, 'Due Date' FROM hdr WHERE o_orderkey % 23 = 0
        UNION ALL SELECT message_id, hr - 1, 12, CAST(CAST(o_orderdate AS DATE) AS STRING) FROM hdr WHERE o_orderkey % 23 = 0
        UNION ALL SELECT message_id, hr, 0, CASE WHEN o_orderkey % 31 = 0 THEN 'ITEM' ELSE CASE o_orderkey % 5 WHEN 1 THEN 'FLOCID' WHEN 2 THEN 'Floc  ID' ELSE 'FLOC_ID' END END FROM hdr
        UNION ALL SELECT message_id, hr, 1, CASE o_orderkey % 5 WHEN 1 THEN 'SCE_STRUCT_' WHEN 2 THEN 'SCE STRUCT__' ELSE 'SCE_STRUCT' END FROM hdr
        UNION ALL SELECT message_id, hr, 2, CASE o_orderkey % 5 WHEN 1 THEN 'PHOTO_LOC_' WHEN 2 THEN 'Photo Loc' ELSE 'PHOTO_LOC' END FROM hdr
        UNION ALL SELECT message_id, hr, 3, CASE o_orderkey % 5 WHEN 1 THEN 'FlightDate' WHEN 2 THEN 'FlightDate' ELSE 'FLIGHT_DATE' END FROM hdr
        UNION ALL SELECT message_id, hr, 4, CASE o_orderkey % 5 WHEN 1 THEN 'Upload Date' WHEN 2 THEN 'UPLOADDATE' ELSE 'UPLOAD_DATE' END FROM hdr
        UNION ALL SELECT message_id, hr, 5, CASE o_orderkey % 5 WHEN 1 THEN 'VendorStatus' WHEN 2 THEN 'VendorStatus' ELSE 'VENDOR_STATUS' END FROM hdr
        UNION ALL SELECT message_id, hr, 6, CASE o_orderkey % 5 WHEN 1 THEN 'BLOCKID' WHEN 2 THEN 'BLOCKID' ELSE 'BLOCK_ID' END FROM hdr
        UNION ALL SELECT message_id, hr, 7, CASE WHEN o_orderkey % 17 = 0 THEN 'RATE' WHEN o_orderkey % 5 = 1 THEN 'UnitRate' ELSE ' UNIT_RATE ' END FROM hdr
        UNION ALL SELECT message_id, r, 0, CASE WHEN l_linenumber = 3 AND l_returnflag = 'N' THEN ''
                                              WHEN l_discount = 0.1 AND l_tax = 0 THEN 'XX-' || CAST(l_partkey AS STRING)
                                              ELSE 'OH-' || CAST(l_partkey AS STRING) END FROM body
        UNION ALL SELECT message_id, r, 1, 'S' || CAST(l_suppkey AS STRING) FROM body
        UNION ALL SELECT message_id, r, 2, 'D' || CAST(l_orderkey % 20 AS STRING) || '_Assets_' || {_YMD.format(c='l_shipdate')} FROM body
        UNION ALL SELECT message_id, r, 3, CAST(CAST(l_shipdate AS DATE) AS STRING) FROM body
        UNION ALL SELECT message_id, r, 4, CAST(month(l_shipdate) AS STRING) || '/' || CAST(day(l_shipdate) AS STRING) || '/' || CAST(year(l_shipdate) AS STRING) FROM body
        UNION ALL SELECT message_id, r, 5, CASE l_linestatus WHEN 'F' THEN 'COMPLETE' ELSE 'PENDING' END FROM body
        UNION ALL SELECT message_id, r, 6, CASE WHEN l_linenumber = 5 THEN 'bad'
                                              ELSE 'D' || lpad(CAST(l_orderkey % 10000 AS STRING), 4, '0') || '-' || lpad(CAST(l_linenumber AS STRING), 4, '0') END FROM body
        UNION ALL SELECT message_id, r, 7, '$' || CAST(l_extendedprice AS STRING) FROM body""",
    # J10 attachment files (orders not pending) and e-mail bodies (orders not of priority 5).
    "invoice_attachment_files": """
        SELECT 'att__M' || CAST(o_orderkey AS STRING) || '__INV-' || CAST(o_orderkey AS STRING) || '.xlsx' AS file_name
        FROM orders WHERE o_orderstatus <> 'P'""",
    # Pages, with a paragraph of character references of all kinds: numeric, hexadecimal, named, Windows, without
    # semicolon, unknown, not a character, and an ampersand alone.
    "html_pages": """
        SELECT page_id, url,
               html || '<P>caf&eacute;&#160;no&#xB0; ' || CAST(page_id AS STRING) || '</p >&#x27;q&#x27; &lt;b&gt; &amp;amp; &copy 2026 &notit; &notin;<br/>'
                    || 'A&#66;&#x43;&#' || CAST(60 + page_id % 40 AS STRING) || '; &euro;&#128;&#x1F600; &bogus; & &#0;&#xD800;&#1;&#99999999999;|<div>&nbsp; </div>x &#13;&#10; y' AS html
        FROM pages""",
    "invoice_email_files": """
        SELECT 'email__M' || CAST(o_orderkey AS STRING) || '_.html' AS file_name,
               '<html><body><table>'
               || '<tr><td><span class="l">Supplier</span></td></tr><tr><td><span class="v">Supplier#' || CAST(o_custkey AS STRING) || '</span></td></tr>'
               || '<tr><td><span>Supplier Invoice #</span></td></tr><tr><td><span> INV-' || CAST(o_orderkey AS STRING) || ' </span></td></tr>'
               || '<tr><td><span>Invoice Date</span></td></tr><tr><td><span>'
               || CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
                       ELSE CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING) || '/' || CAST(year(o_orderdate) AS STRING) END
               || '</span></td></tr>'
               || CASE WHEN o_orderkey % 3 = 0 THEN '<p>Company&#160;Code</p><p>CC&#x2d;' || CAST(o_custkey % 10 AS STRING) || ' caf&eacute;</p>'
                       WHEN o_orderkey % 3 = 1 THEN '<p>company  code</p><p>Total Amount</p>'
                       ELSE '<tr><td><span>Company Code</span></td></tr><tr><td><span>CC' || CAST(o_custkey % 10 AS STRING) || '</span></td></tr>' END
               || '<tr><td><span>Total Amount</span></td></tr><tr><td><span>$' || CAST(o_totalprice AS STRING) || ' USD</span></td></tr>'
               || '<tr><td><span>On behalf of / Preparer</span></td></tr><tr><td><span>Clerk &amp; Co ' || substr(o_orderpriority, 1, 1) || '</span></td></tr>'
               || '</table></body></html>' AS html
        FROM orders WHERE substr(o_orderpriority, 1, 1) <> '5'""",
    # Transmission snapshots of the order book: two package slots per floc.
    "snapshot_trans_prev_raw": """
        SELECT 'TW-' || CAST(o_orderkey AS STRING) AS FLOC,
               CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS Date_Removed,
               o_totalprice AS AMOUNT,
               'T' || substr(o_orderpriority, 1, 1) AS pkg_1,
               CASE WHEN o_custkey % 3 = 0 THEN 'T9' ELSE ' ' END AS pkg_2
        FROM orders WHERE o_orderdate < DATE '2001-01-01'""",
    "snapshot_trans_cur_raw": """
        SELECT 'TW-' || CAST(o_orderkey AS STRING) AS FLOC,
               CASE WHEN o_orderstatus = 'F' AND substr(o_orderpriority, 1, 1) <> '3' THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
                    WHEN o_orderstatus = 'O' AND substr(o_orderpriority, 1, 1) = '2' THEN CAST(CAST(o_orderdate AS DATE) AS STRING) END AS Date_Removed,
               CASE WHEN substr(o_orderpriority, 1, 1) = '4' THEN o_totalprice + 1 ELSE o_totalprice END AS AMOUNT,
               'T' || substr(o_orderpriority, 1, 1) AS pkg_1,
               CASE WHEN o_custkey % 3 = 1 THEN 'T9' ELSE '' END AS pkg_2
        FROM orders WHERE NOT (o_orderstatus = 'P' AND substr(o_orderpriority, 1, 1) = '1')""",
    # Invoice line fact (invoiced lineitems) keyed like the assignments; paid when shipped out.
    "invoice_line_fact": """
        SELECT 'V' || CAST(l_suppkey % 4 AS STRING) AS vendor,
               (CASE WHEN l_linenumber <= 5 THEN 'D' ELSE 'T' END) || CAST(l_orderkey % 20 AS STRING) || '|FL-' || CAST(l_partkey AS STRING) AS scope_floc_key,
               'INV-' || CAST(l_orderkey AS STRING) AS invoice_id,
               l_linestatus = 'F' AS paid_flg
        FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 30""",
    # A drop folder's listing: a file per order, most with their time in the name.
    "drop_listing": """
        SELECT 'lake/drop/' || file_name AS path, file_name, length, modification_time
        FROM (SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'manual_' || CAST(o_orderkey AS STRING) || '.csv'
                          ELSE 'azure_inspectapp_surveys_' || CAST(year(o_orderdate) AS STRING) || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
                               || lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '_' || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || '1500Z.csv' END AS file_name,
                     o_custkey AS length, o_orderdate AS modification_time
              FROM orders)""",
    # Invoice versions: orders sharing an invoice number are versions of it.
    "invoice_versions": """
        SELECT 'INV-' || CAST(o_orderkey % 5000 AS STRING) AS invoice_number, 'M' || CAST(o_orderkey AS STRING) AS message_id,
               o_orderdate AS loaded_at, o_totalprice AS total_amount, o_orderstatus AS status
        FROM orders""",
    "invoice_version_lines": """
        SELECT 'M' || CAST(l_orderkey AS STRING) AS message_id, l_linenumber AS line_number, 'FL-' || CAST(l_partkey AS STRING) AS floc,
               l_extendedprice AS amount
        FROM lineitem""",
    # Accumulating invoice table: a first load and a later, overlapping load.
    "invoice_load_1": """
        SELECT 'M' || CAST(o_orderkey AS STRING) AS message_id, 'INV-' || CAST(o_orderkey AS STRING) AS invoice_number,
               o_totalprice AS total_amount, o_orderstatus AS status, 1 AS load_seq
        FROM orders WHERE o_orderdate < DATE '1998-01-01'""",
    "invoice_load_2": """
        SELECT 'M' || CAST(o_orderkey AS STRING) AS message_id, 'INV-' || CAST(o_orderkey AS STRING) AS invoice_number,
               o_totalprice + 1 AS total_amount, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS status,
               2 AS load_seq
        FROM orders WHERE o_orderdate >= DATE '1997-01-01'""",
    # File registry ledger (one file per order) and updates from the lineitems.
    "file_ledger": """
        SELECT 'h' || CAST(o_orderkey AS STRING) AS file_hash, 'drop/att__M' || CAST(o_orderkey AS STRING) || '.xlsx' AS path,
               CASE WHEN o_orderstatus = 'F' THEN 'LOADED' ELSE 'FAILED' END AS status
        FROM orders""",
    "file_ledger_updates": """
        SELECT 'h' || CAST(l_orderkey AS STRING) AS file_hash, 'RELOADED' AS status, count(*) AS line_count
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey""",
    "incoming_files": """
        SELECT DISTINCT 'h' || CAST(l_orderkey AS STRING) AS file_hash, 'drop/att__M' || CAST(l_orderkey AS STRING) || '.xlsx' AS path
        FROM lineitem""",
    # Run ledger: every event row is a state record of one run.
    "run_ledger": """
        SELECT 'run-' || CAST(user_id % 50 AS STRING) AS run_id, ts AS event_ts,
               CASE event_type WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'error' THEN 'FAILED' ELSE 'RUNNING' END AS status
        FROM events""",
    # Successive releases: a vendor's full list of every week, with the packages that events name for a floc
    # (one floc may be in several packages at once, and with several vendors).
    "release_history": """
        SELECT 'V' || CAST(event_id % 4 AS STRING) AS vendor,
               'FL-' || CAST((user_id * 37) % 200 AS STRING) AS floc,
               'D' || CAST(event_id % 3 AS STRING) AS scope_id,
               CAST(date_trunc('week', ts) AS DATE) AS effective_ts
        FROM events""",
}

# Spark-only texts for views whose shared form is slow on Spark: the cells
# view emits its cells with one ``inline`` per source row instead of a
# UNION ALL per cell (Spark would recompute the CTEs once per branch).  The
# rows are identical to the shared form.
_H = "named_struct('row_idx', CAST({r} AS INT), 'col_idx', {c}, 'value', CAST({v} AS STRING))"
_B = "named_struct('col_idx', {c}, 'value', CAST({v} AS STRING))"
ROLE_SQL_SPARK: dict[str, str] = {
    "invoice_cells": f"""
        WITH hdr AS (SELECT o_orderkey, 'M' || CAST(o_orderkey AS STRING) AS message_id, 5 + o_orderkey % 3 + CASE WHEN o_orderkey % 23 = 0 THEN 90 ELSE 0 END AS hr,
                            o_orderdate, o_custkey, o_totalprice, o_orderpriority FROM orders),
             body AS (SELECT 'M' || CAST(l_orderkey AS STRING) AS message_id,
                             5 + l_orderkey % 3 + CASE WHEN l_orderkey % 23 = 0 THEN 90 ELSE 0 END + row_number() OVER (PARTITION BY l_orderkey
                                 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS r,
                             l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_discount, l_tax,
                             l_extendedprice, l_shipdate FROM lineitem)
        SELECT message_id, inline(filter(array(
            {_H.format(r=0, c=0, v="'INVOICE NUMBER'")},
            {_H.format(r=0, c=2, v="'INV-' || CAST(o_orderkey AS STRING)")},
            {_H.format(r=1, c=0, v="'Invoice Date'")},
            {_H.format(r=1, c=1, v="CAST(CAST(o_orderdate AS DATE) AS STRING)")},
            {_H.format(r=2, c=0, v="'TOTAL QTY OF STRUCTURES'")},
            {_H.format(r=2, c=1, v="'approx ' || CAST(o_custkey % 50 AS STRING) || ' poles'")},
            {_H.format(r=3, c=0, v="'INVOICE TOTAL'")},
            {_H.format(r=3, c=1, v="'$' || CAST(o_totalprice AS STRING)")},
            {_H.format(r=4, c=0, v="CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'PO' ELSE 'Payment Terms' END")},
            {_H.format(r=4, c=1, v="CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'PO-' || CAST(o_custkey AS STRING) ELSE 'NET' || CAST(o_custkey % 3 * 15 AS STRING) END")},
            {_H.format(r="hr", c=0, v="CASE WHEN o_orderkey % 31 = 0 THEN 'ITEM' ELSE CASE o_orderkey % 5 WHEN 1 THEN 'FLOCID' WHEN 2 THEN 'Floc  ID' ELSE 'FLOC_ID' END END")},
            {_H.format(r="hr", c=1, v="CASE o_orderkey % 5 WHEN 1 THEN 'SCE_STRUCT_' WHEN 2 THEN 'SCE STRUCT__' ELSE 'SCE_STRUCT' END")},
            {_H.format(r="hr", c=2, v="CASE o_orderkey % 5 WHEN 1 THEN 'PHOTO_LOC_' WHEN 2 THEN 'Photo Loc' ELSE 'PHOTO_LOC' END")},
            {_H.format(r="hr", c=3, v="CASE o_orderkey % 5 WHEN 1 THEN 'FlightDate' WHEN 2 THEN 'FlightDate' ELSE 'FLIGHT_DATE' END")},
            {_H.format(r="hr", c=4, v="CASE o_orderkey % 5 WHEN 1 THEN 'Upload Date' WHEN 2 THEN 'UPLOADDATE' ELSE 'UPLOAD_DATE' END")},
            {_H.format(r="hr", c=5, v="CASE o_orderkey % 5 WHEN 1 THEN 'VendorStatus' WHEN 2 THEN 'VendorStatus' ELSE 'VENDOR_STATUS' END")},
            {_H.format(r="hr", c=6, v="CASE o_orderkey % 5 WHEN 1 THEN 'BLOCKID' WHEN 2 THEN 'BLOCKID' ELSE 'BLOCK_ID' END")},
            {_H.format(r="hr", c=7, v="CASE WHEN o_orderkey % 17 = 0 THEN 'RATE' WHEN o_orderkey % 5 = 1 THEN 'UnitRate' ELSE ' UNIT_RATE ' END")}
            , CASE WHEN o_orderkey % 23 = 0 THEN {_H.format(r="hr - 1", c=9, v="'Due Date'")} END
            , CASE WHEN o_orderkey % 23 = 0 THEN {_H.format(r="hr - 1", c=12, v="CAST(CAST(o_orderdate AS DATE) AS STRING)")} END
        ), c -> c IS NOT NULL)) FROM hdr
        UNION ALL
        SELECT message_id, CAST(r AS INT) AS row_idx, b.col_idx, b.value FROM (
            SELECT message_id, r, inline(array(
                {_B.format(c=0, v="CASE WHEN l_linenumber = 3 AND l_returnflag = 'N' THEN '' WHEN l_discount = 0.1 AND l_tax = 0 THEN 'XX-' || CAST(l_partkey AS STRING) ELSE 'OH-' || CAST(l_partkey AS STRING) END")},
                {_B.format(c=1, v="'S' || CAST(l_suppkey AS STRING)")},
                {_B.format(c=2, v="'D' || CAST(l_orderkey % 20 AS STRING) || '_Assets_' || " + _YMD.format(c='l_shipdate'))},
                {_B.format(c=3, v="CAST(CAST(l_shipdate AS DATE) AS STRING)")},
                {_B.format(c=4, v="CAST(month(l_shipdate) AS STRING) || '/' || CAST(day(l_shipdate) AS STRING) || '/' || CAST(year(l_shipdate) AS STRING)")},
                {_B.format(c=5, v="CASE l_linestatus WHEN 'F' THEN 'COMPLETE' ELSE 'PENDING' END")},
                {_B.format(c=6, v="CASE WHEN l_linenumber = 5 THEN 'bad' ELSE 'D' || lpad(CAST(l_orderkey % 10000 AS STRING), 4, '0') || '-' || lpad(CAST(l_linenumber AS STRING), 4, '0') END")},
                {_B.format(c=7, v="'$' || CAST(l_extendedprice AS STRING)")}
            )) FROM body
        ) AS b""",
}

# Spark-side column renames: sheet headers that are not plain identifiers.
ROLE_RENAMES: dict[str, dict[str, str]] = {
    "snapshot_trans_prev_raw": {"pkg_1": "Scope Package #1", "pkg_2": "Scope Package #2"},
    "snapshot_trans_cur_raw": {"pkg_1": "Scope Package #1", "pkg_2": "Scope Package #2"},
    "assignment_sheets_raw": {"pkg_1": "Scope Package #1", "pkg_2": "scope package  # 2", "pkg_3": "Scope Package#3"},
    "events_raw": {"pkg_1": "Scope Package #1", "pkg_2": "Scope Package #2"},
    "events_removal_trans_raw": {"pkg_1": "Scope Package #1", "pkg_2": "Scope Package #2"},
    "events_move_trans_raw": {"pkg_1": "Scope Package #1", "pkg_2": "Scope Package #2"},
    "release_trans_raw": {"pkg_1": "Scope Package #1", "pkg_2": "scope package  # 2", "pkg_3": "Scope Package#3"},
}

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Run values used by the catalogue (literals, so plans stay deterministic).
RUNS = {
    "release_dist": ("2026-01-15", "rel-d-0001"),
    "release_trans": ("2026-01-15", "rel-t-0001"),
    "helo": ("2026-01-16", "helo-0001"),
    "gold": ("2026-01-20", "gold-0001"),
    "deliveries": ("2026-01-18", "gcp-0001"),
    "survey": ("2026-01-19", "az-0001"),
    "scope_master": ("2026-01-10", "sm-0001"),
    "rate_card": ("2026-01-11", "rc-0001"),
    "eligibility": ("2026-02-01", "elig-0001"),
    "invoices": ("2026-02-03", "inv-0001"),
}
SOURCE_SYSTEM = "INTERNAL"
MIN_IMAGES = 8
