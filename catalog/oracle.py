"""The registered queries as plain SQL over the same tables."""

DAY_MS = 86400000

# 2024-01-15 00:00 and 1995-08-09 00:00 in Asia/Ho_Chi_Minh (UTC+7), epoch ms.
EVENT_DAY = 1705251600000
SHIP_DAY = 807901200000
AS_OF = 1705320000  # 2024-01-15 12:00 UTC, epoch s
MODIFIED_SINCE = 978307200000  # 2001-01-01 00:00 UTC, epoch ms
ZONE_MS = 7 * 3600 * 1000

VIEWS = {
    "ev": f"""
        SELECT CAST(event_id AS VARCHAR) AS "Id", CAST(user_id AS VARCHAR) AS "Phone",
               (epoch_us(ts) // 86400000000) * {DAY_MS} AS "Date",
               CAST(month(ts) AS INTEGER) AS "Month", CAST(year(ts) AS INTEGER) AS "Year",
               epoch_us(ts) // 1000 AS "TimeStamp", 'Level1' AS "MembershipCode", event_type AS "Event",
               event_type AS "ReportCode", event_type AS "EventName", event_type AS "ReportName", props AS "Data"
        FROM events""",
    "tx": f"""
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS "Id",
               CAST(o_custkey AS VARCHAR) AS "Phone",
               (epoch_us(l_shipdate) // 86400000000) * {DAY_MS} AS "Date",
               CAST(month(l_shipdate) AS INTEGER) AS "Month", CAST(year(l_shipdate) AS INTEGER) AS "Year",
               o_orderstatus AS "EventCode", l_returnflag AS "ReportCode", CAST(NULL AS VARCHAR) AS "ActivityId",
               o_orderpriority AS "CampaignId", CAST(l_suppkey AS VARCHAR) AS "RuleId",
               'Campaign ' || o_orderpriority AS "CampaignName", 'Rule ' || CAST(l_suppkey AS VARCHAR) AS "RuleName",
               'Order ' || o_orderstatus AS "EventName", 'Return ' || l_returnflag AS "ReportName",
               CASE WHEN l_linestatus = 'O' THEN 'Level1' ELSE 'Level2' END AS "MembershipCode",
               CASE WHEN l_returnflag = 'R' THEN 'AddPoint' ELSE 'Notify' END AS "Name",
               CAST(l_quantity AS INTEGER) AS "Value", epoch_us(l_shipdate) // 1000 AS "TimeStamp",
               l_linestatus AS "Type"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "scored": """SELECT * FROM tx WHERE "Name" = 'AddPoint'""",
    "last_code": """
        SELECT "Phone", "Month", "Year", "MembershipCode"
        FROM (SELECT *, row_number() OVER (PARTITION BY "Phone", "Month", "Year"
                                           ORDER BY "TimeStamp" DESC, "MembershipCode" DESC) AS rn FROM scored)
        WHERE rn = 1""",
    "monthly": """
        SELECT "Phone" AS phone, c."MembershipCode" AS membershipcode, 'Nhập môn' AS membershipname,
               "Month" AS month, "Year" AS year, CAST(9999 AS INTEGER) AS rank,
               t.totalpoints, t.timestamp
        FROM (SELECT "Phone", "Month", "Year", CAST(sum("Value") AS BIGINT) AS totalpoints,
                     max("TimeStamp") AS timestamp FROM scored GROUP BY ALL) t
        JOIN last_code c USING ("Phone", "Month", "Year")""",
    "finished": """
        SELECT "Phone" AS phone, max(code) AS membershipcode, "Month" AS month, "Year" AS year,
               CAST(sum("Value") AS BIGINT) AS totalpoints, max("TimeStamp") AS timestamp
        FROM (SELECT *, 'Level2' AS code FROM scored WHERE "Type" = 'F') GROUP BY "Phone", "Month", "Year" """,
    "opened": """
        SELECT "Phone" AS phone, max(code) AS membershipcode, "Month" AS month, "Year" AS year,
               CAST(sum("Value") AS BIGINT) AS totalpoints, max("TimeStamp") AS timestamp
        FROM (SELECT *, 'Level1' AS code FROM scored WHERE "Type" = 'O') GROUP BY "Phone", "Month", "Year" """,
    "yearly": f"""
        SELECT t.phone, l.membershipcode, l.membershipname, t.year, CAST(0 AS INTEGER) AS rank, t.totalpoints,
               epoch_us(make_timestamp(t.year, 1, 1, 0, 0, 0.0)) // 1000 - {ZONE_MS} AS timestamp
        FROM (SELECT phone, year, CAST(sum(totalpoints) AS BIGINT) AS totalpoints FROM monthly GROUP BY ALL) t
        JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY phone, year
                             ORDER BY month DESC, timestamp DESC) AS rn FROM monthly) WHERE rn = 1) l
          ON t.phone = l.phone AND t.year = l.year""",
    "all_time": """
        SELECT regexp_replace(md5(phone), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS "Id",
               phone AS "Phone", 'Standard' AS "Package", max_code AS "MembershipCode", total AS "TotalPoints"
        FROM (SELECT phone, CAST(sum(totalpoints) AS BIGINT) AS total FROM yearly GROUP BY phone)
        JOIN (SELECT phone, membershipcode AS max_code FROM (SELECT *, row_number() OVER (
                PARTITION BY phone ORDER BY year DESC) AS rn FROM yearly) WHERE rn = 1) USING (phone)""",
    "ranked_monthly": """
        SELECT * EXCLUDE (rank), CAST(row_number() OVER (PARTITION BY year, month
               ORDER BY totalpoints DESC, timestamp, phone) AS INTEGER) AS rank FROM monthly""",
    "ranked_yearly": """
        SELECT * EXCLUDE (rank), CAST(row_number() OVER (PARTITION BY year
               ORDER BY totalpoints DESC, timestamp, phone) AS INTEGER) AS rank FROM yearly""",
    "profile": """
        SELECT CAST(c_custkey AS VARCHAR) AS "Id", CAST(c_custkey AS VARCHAR) AS "Phone", CAST(1 AS INTEGER) AS "Level",
               CASE WHEN NOT c_acctbal < 0 THEN points END AS "TotalPoints",
               CAST(c_custkey + 1 AS INTEGER) AS "Rank", last_ms, 'Level1' AS "MembershipCode"
        FROM customer LEFT JOIN (SELECT "Phone", CAST(sum("Value") AS BIGINT) AS points, max("TimeStamp") AS last_ms
                                 FROM scored GROUP BY "Phone") ON CAST(c_custkey AS VARCHAR) = "Phone" """,
    "levels": """
        SELECT CAST(n AS INTEGER) AS level, CASE WHEN n = 1 THEN 0 ELSE 50 + 75 * (n - 1) * (n - 2) END AS low
        FROM range(1, 101) t(n)""",
    "leveled": """
        SELECT p."Id", p."Phone", p."MembershipCode", p."TotalPoints", p."Level" AS old_level, p.last_ms,
               (SELECT max(level) FROM levels WHERE low <= coalesce(p."TotalPoints", 0)) AS new_level
        FROM profile p""",
    "tiered": """
        SELECT phone, year, totalpoints, timestamp, rank, rank / n AS percentile,
               CASE WHEN totalpoints < 30 THEN 'Level1'
                    WHEN rank / n > 0.00 AND rank / n <= 0.01 THEN 'Level5'
                    WHEN rank / n > 0.01 AND rank / n <= 0.05 THEN 'Level4'
                    WHEN rank / n > 0.05 AND rank / n <= 0.10 THEN 'Level3'
                    ELSE 'Level2' END AS membershipcode
        FROM ranked_yearly JOIN (SELECT year, count(*) AS n FROM yearly WHERE totalpoints > 0 GROUP BY year) USING (year)""",
    "tier_names": """
        SELECT * FROM (VALUES ('Level1', 'Nhập môn'), ('Level2', 'Ngôi sao đang lên'), ('Level3', 'Uy tín'),
                              ('Level4', 'Nổi tiếng'), ('Level5', 'Tối thượng')) v(membershipcode, membershipname)""",
    "day_rules": """
        SELECT day AS date, "CampaignId", "RuleId", "RuleName", min("CampaignName") AS campaignname,
               count(DISTINCT "Phone") AS profiles_evaluated, count("Name") AS total_actions,
               count(*) FILTER (WHERE "Name" = 'AddPoint') AS addpoint_actions,
               CAST(sum("Value") FILTER (WHERE "Name" = 'AddPoint') AS BIGINT) AS points_awarded
        FROM dated GROUP BY day, "CampaignId", "RuleId", "RuleName" """,
    "day_campaigns": """
        SELECT day AS date, "CampaignId", count(DISTINCT "Phone") AS total_profiles_evaluated,
               count(*) FILTER (WHERE "Name" = 'AddPoint') AS total_successful_actions,
               CAST(sum("Value") FILTER (WHERE "Name" = 'AddPoint') AS BIGINT) AS total_points_awarded
        FROM dated GROUP BY day, "CampaignId" """,
    "flow": """
        SELECT "CampaignId" AS campaignid, campaignname, "RuleId" AS ruleid, "RuleName" AS rulename, date,
               CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
               CAST(row_number() OVER (PARTITION BY date, "CampaignId" ORDER BY "RuleId", "RuleName") AS INTEGER)
                 AS rule_sequence,
               total_profiles_evaluated, profiles_evaluated, total_actions, addpoint_actions, points_awarded,
               total_successful_actions, total_points_awarded, profiles_evaluated - total_actions AS profiles_not_matched
        FROM day_rules JOIN day_campaigns USING (date, "CampaignId")""",
    "report": f"""
        SELECT CASE WHEN event_type IN ('view', 'click') THEN 'VML_' ELSE 'OBD_' END
                 || lpad(CAST(user_id AS VARCHAR), 12, '0') AS deviceimei,
               (epoch_us(ts) // 86400000000) * 86400 - 7 * 3600 AS date,
               CAST(floor(value * 100) AS INTEGER) AS distance, CAST(hour(ts) AS INTEGER) AS drivingtime,
               CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year
        FROM events""",
    "driving": """
        SELECT regexp_replace(md5(deviceimei || '|' || date || '|' || distance || '|' || drivingtime),
                 '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS "Id",
               s_name AS "Phone", date AS "Date", month AS "Month", year AS "Year", date AS "TimeStamp",
               'Level1' AS "MembershipCode", 'DrivingDaily' AS "Event", 'DrivingDaily' AS "ReportCode",
               'Lái xe hàng ngày' AS "EventName", 'Lái xe hàng ngày' AS "ReportName",
               CAST(distance // 1000 AS VARCHAR) AS "Data"
        FROM report JOIN supplier ON ltrim(substr(deviceimei, 5), '0') = CAST(s_suppkey AS VARCHAR)
        WHERE deviceimei LIKE 'VML!_%' ESCAPE '!' AND distance >= 1000""",
    "live": """
        SELECT CAST(event_id AS VARCHAR) AS id, CAST(event_id % 180 - 90 AS DOUBLE) AS lat,
               CAST(event_id % 360 - 180 AS DOUBLE) AS lng, epoch_us(ts) // 1000000 AS submit_time,
               epoch_us(ts) // 1000000 + 86400 AS expired_display_time,
               CASE event_type WHEN 'click' THEN 'WaitingVerification' WHEN 'view' THEN 'Verified'
                               ELSE 'Rejected' END AS status
        FROM events""",
    "released": f"""
        SELECT id, lat, lng, expired_display_time, (row_number() OVER (ORDER BY id) - 1) // 100 AS batch_no,
               count(*) OVER () AS total_records
        FROM live WHERE status = 'Verified' AND expired_display_time > {AS_OF}""",
    "copies": """SELECT "Id", count(*) AS copies FROM tx GROUP BY "Id" """,
}

_NEWEST = """row_number() OVER (PARTITION BY "Id" ORDER BY "TimeStamp" DESC NULLS LAST, "Phone" DESC, "Date" DESC,
    "Month" DESC, "Year" DESC, "EventCode" DESC, "ReportCode" DESC, "CampaignId" DESC, "RuleId" DESC,
    "CampaignName" DESC, "RuleName" DESC, "EventName" DESC, "ReportName" DESC, "MembershipCode" DESC, "Name" DESC,
    "Value" DESC, "Type" DESC)"""
VIEWS["once"] = f'SELECT * EXCLUDE (rn) FROM (SELECT *, {_NEWEST} AS rn FROM tx) WHERE rn = 1'
VIEWS["once_f"] = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, {_NEWEST} AS rn FROM tx WHERE "Type" = 'F') WHERE rn = 1"""
VIEWS["once_o"] = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, {_NEWEST} AS rn FROM tx WHERE "Type" = 'O') WHERE rn = 1"""

_NEEDS = {
    "scored": ["tx"],
    "last_code": ["scored"],
    "monthly": ["last_code"],
    "finished": ["scored"],
    "opened": ["scored"],
    "yearly": ["monthly"],
    "all_time": ["yearly"],
    "ranked_monthly": ["monthly"],
    "ranked_yearly": ["yearly"],
    "profile": ["scored"],
    "leveled": ["profile", "levels"],
    "tiered": ["ranked_yearly"],
    "day_rules": ["dated"],
    "day_campaigns": ["dated"],
    "flow": ["day_rules", "day_campaigns"],
    "driving": ["report"],
    "released": ["live"],
    "copies": ["tx"],
    "once": ["tx"],
    "once_f": ["tx"],
    "once_o": ["tx"],
    "dated": ["tx"],
}


def _sql(query: str, *views: str, **given: str) -> str:
    """The query with the views it needs in front."""
    ordered: list[str] = []

    def add(name):
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    bodies = {**VIEWS, **given}
    return "WITH " + ",\n".join(f"{name} AS ({bodies[name]})" for name in ordered) + "\n" + query


_ALL_DAYS = 'SELECT *, CAST(make_timestamp("TimeStamp" * 1000) AS DATE) AS day FROM tx'
_ALL_MONTHS = """SELECT *, CAST(date_trunc('month', make_timestamp("TimeStamp" * 1000)) AS DATE) AS day FROM tx"""
_ONE_DAY = f"""SELECT *, DATE '1995-08-09' AS day FROM tx
               WHERE "TimeStamp" >= {SHIP_DAY} AND "TimeStamp" < {SHIP_DAY + DAY_MS}"""

_SUMMARY = """SELECT "Phone" AS phone, "Date" AS date,
       count(*) FILTER (WHERE "Event" = 'click') AS total_submitted_report,
       count(*) FILTER (WHERE "Event" = 'purchase') AS total_approved_report,
       count(*) FILTER (WHERE "Event" = 'view') AS total_driving_report
FROM ev {} GROUP BY "Phone", "Date" """

_CHANGED = 'SELECT "Id", "Phone", "MembershipCode", "TotalPoints", {old} AS old_level, new_level FROM leveled '

ORACLE = {
    "recalc_monthly": _sql("SELECT * FROM monthly", "monthly"),
    "recalc_monthly_positive": _sql("SELECT * FROM monthly", "monthly", scored=VIEWS["scored"] + ' AND "Value" > 0'),
    "recalc_one_month": _sql("SELECT * FROM monthly WHERE year = 1998 AND month = 6", "monthly"),
    "recalc_monthly_upsert": _sql(
        """SELECT m.phone, coalesce(f.membershipcode, m.membershipcode) AS membershipcode, m.membershipname,
                  m.month, m.year, m.rank, m.totalpoints, m.timestamp
           FROM monthly m LEFT JOIN finished f ON m.phone = f.phone AND m.month = f.month AND m.year = f.year""",
        "monthly", "finished",
    ),
    "increment_members": _sql(
        """SELECT phone, coalesce(f.membershipcode, o.membershipcode) AS membershipcode, 'Nhập môn' AS membershipname,
                  month, year, CAST(9999 AS INTEGER) AS rank,
                  coalesce(f.totalpoints, 0) + coalesce(o.totalpoints, 0) AS totalpoints,
                  coalesce(o.timestamp, f.timestamp) AS timestamp
           FROM finished f FULL JOIN opened o USING (phone, month, year)""",
        "finished", "opened",
    ),
    "recalc_yearly": _sql("SELECT * FROM yearly", "yearly"),
    "recalc_all_time": _sql("SELECT * FROM all_time", "all_time"),
    "upsert_profiles": _sql(
        """SELECT coalesce(p."Id", a."Id") AS "Id", "Phone", p."Level",
                  CASE WHEN a."Phone" IS NOT NULL THEN a."TotalPoints" ELSE p."TotalPoints" END AS "TotalPoints",
                  p."Rank", coalesce(p."MembershipCode", a."MembershipCode") AS "MembershipCode"
           FROM profile p FULL JOIN all_time a USING ("Phone")""",
        "profile", "all_time",
    ),
    "rank_monthly": _sql("SELECT * FROM ranked_monthly", "ranked_monthly"),
    "leaders": _sql("SELECT * FROM ranked_monthly WHERE rank <= 10", "ranked_monthly"),
    "rank_yearly": _sql("SELECT * FROM ranked_yearly", "ranked_yearly"),
    "rank_all_time": _sql(
        """SELECT * FROM (SELECT "Id" AS id, "Phone" AS phone, coalesce("TotalPoints", 0) AS totalpoints,
                  "Rank" AS old_rank, CAST(row_number() OVER (ORDER BY coalesce("TotalPoints", 0) DESC, "Phone")
                  AS INTEGER) AS new_rank FROM profile) WHERE new_rank <> old_rank""",
        "profile",
    ),
    "ties_report": _sql(
        """SELECT * FROM (SELECT year, totalpoints, rank, phone, timestamp,
                  count(*) OVER (PARTITION BY year, totalpoints) AS users_with_same_points FROM ranked_yearly)
           WHERE users_with_same_points > 1""",
        "ranked_yearly",
    ),
    "duplicate_ranks": _sql(
        "SELECT year, rank, count(*) AS members FROM ranked_yearly GROUP BY year, rank HAVING count(*) > 1",
        "ranked_yearly",
    ),
    "points_summary": _sql(
        """SELECT year, count(totalpoints) AS members, min(totalpoints) AS min_points, max(totalpoints) AS max_points,
                  CAST(sum(totalpoints) AS DOUBLE) / count(totalpoints) AS mean_points FROM yearly GROUP BY year""",
        "yearly",
    ),
    "top_members": _sql(
        """SELECT "Phone", "TotalPoints", "MembershipCode" FROM all_time ORDER BY "TotalPoints" DESC, "Phone" LIMIT 10""",
        "all_time",
    ),
    "assign_membership": _sql(
        """SELECT phone, CASE WHEN totalpoints >= 200 THEN 'Level2' ELSE 'Level1' END AS membershipcode,
                  CASE WHEN totalpoints >= 200 THEN 'Ngôi sao đang lên' ELSE 'Nhập môn' END AS membershipname,
                  year, rank, totalpoints, timestamp, percentile FROM tiered""",
        "tiered",
    ),
    "assign_membership_percentiles": _sql(
        "SELECT * FROM tiered JOIN tier_names USING (membershipcode)", "tiered", "tier_names"
    ),
    "membership_distribution": _sql(
        """SELECT membershipcode, membershipname, count(*) AS user_count, round(avg(totalpoints), 2) AS avg_points,
                  min(totalpoints) AS min_points, max(totalpoints) AS max_points
           FROM tiered JOIN tier_names USING (membershipcode) GROUP BY membershipcode, membershipname""",
        "tiered", "tier_names",
    ),
    "sync_membership_to_profiles": _sql(
        """SELECT p."Id", p."Phone", coalesce(m.membershipcode, p."MembershipCode") AS "MembershipCode"
           FROM profile p LEFT JOIN monthly m ON p."Phone" = m.phone AND m.year = 1998 AND m.month = 6""",
        "profile", "monthly",
    ),
    "sync_membership_to_yearly": _sql(
        """SELECT y.phone, coalesce(m.membershipcode, y.membershipcode) AS membershipcode, y.membershipname,
                  y.year, y.rank, y.totalpoints, y.timestamp
           FROM yearly y LEFT JOIN monthly m ON y.phone = m.phone AND m.year = 1998 AND m.month = 6 AND y.year = 1998""",
        "yearly", "monthly",
    ),
    "update_levels": _sql(_CHANGED.format(old="old_level") + "WHERE new_level <> old_level", "leveled"),
    "update_levels_recent": _sql(
        _CHANGED.format(old="old_level")
        + f"WHERE new_level <> old_level AND (last_ms IS NULL OR last_ms >= {MODIFIED_SINCE})",
        "leveled",
    ),
    "level_transactions": _sql(
        f"""SELECT regexp_replace(md5("Id" || '|' || new_level || '|{AS_OF}'),
                    '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') AS "Id", "Phone",
                   CAST({EVENT_DAY // 1000} AS BIGINT) AS "Date", CAST(1 AS INTEGER) AS "Month",
                   CAST(2024 AS INTEGER) AS "Year", '' AS "ReportCode",
                   '8aaaa253-195f-4710-8d8f-23ce1e8c6f2d' AS "CampaignId",
                   '8aaaa253-195f-4710-8d8f-23ce1e8c6f2d' AS "RuleId", 'Cập nhật level' AS "CampaignName",
                   'Upgrade level profile rule' AS "RuleName", 'UpgradeLevel' AS "EventCode",
                   'Nâng hạng cho người dùng' AS "EventName", 'Nâng hạng cho người dùng' AS "ReportName",
                   'UpgradeLevel' AS "Name", new_level AS "Value", CAST({AS_OF} AS BIGINT) AS "TimeStamp",
                   "MembershipCode", 'System' AS "Type"
            FROM leveled WHERE new_level <> old_level""",
        "leveled",
    ),
    "apply_levels": _sql('SELECT "Id", "Phone", new_level AS "Level", "TotalPoints" FROM leveled', "leveled"),
    "level_distribution": _sql(
        """SELECT level, count(*) AS members
           FROM (SELECT (SELECT max(level) FROM levels WHERE low <= m.totalpoints) AS level FROM monthly m) GROUP BY level""",
        "monthly", "levels",
    ),
    "publish_monthly": _sql(
        """SELECT 'membership:monthly:' || year || ':' || month || ':' || phone AS "Id", phone AS "Phone",
                  membershipcode AS "MembershipCode", month AS "Month", year AS "Year", rank AS "Rank",
                  membershipname AS "MembershipName", totalpoints AS "TotalPoints" FROM ranked_monthly""",
        "ranked_monthly",
    ),
    "publish_yearly": _sql(
        """SELECT 'membership:yearly:' || year || ':' || phone AS "Id", phone AS "Phone",
                  membershipcode AS "MembershipCode", year AS "Year", rank AS "Rank",
                  membershipname AS "MembershipName", totalpoints AS "TotalPoints" FROM ranked_yearly""",
        "ranked_yearly",
    ),
    "publish_profiles": _sql(
        f"""SELECT "Phone", "Level", coalesce("TotalPoints", 0) AS "TotalPoints", "Rank",
                   coalesce(last_ms // 1000, {AS_OF}) AS "LastUpdated", "MembershipCode",
                   'Nhập môn' AS "MembershipName" FROM profile""",
        "profile",
    ),
    "roll_forward": _sql(
        f"""SELECT phone, membershipcode, membershipname, CAST(1 AS INTEGER) AS month, CAST(1999 AS INTEGER) AS year,
                   rank, CAST(0 AS BIGINT) AS totalpoints,
                   epoch_us(TIMESTAMP '1999-01-01 00:00:00') // 1000 - {ZONE_MS} AS timestamp
            FROM monthly WHERE year = 1998 AND month = 12""",
        "monthly",
    ),
    "event_summary": _sql(_SUMMARY.format(""), "ev"),
    "event_summary_day": _sql(
        _SUMMARY.format(f'WHERE "TimeStamp" >= {EVENT_DAY} AND "TimeStamp" < {EVENT_DAY + DAY_MS}'), "ev"
    ),
    "rule_flow_metrics": _sql(
        "SELECT * REPLACE (CAST(date AS VARCHAR) AS date), CAST(NULL AS BIGINT) AS timestamp FROM flow",
        "flow", dated=_ALL_DAYS,
    ),
    "rule_flow_metrics_day": _sql(
        f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date), CAST({AS_OF * 1000} AS BIGINT) AS timestamp FROM flow",
        "flow", dated=_ONE_DAY,
    ),
    "campaign_overview": _sql(
        """SELECT DISTINCT campaignname, total_profiles_evaluated, total_successful_actions, total_points_awarded
           FROM flow""",
        "flow", dated=_ALL_DAYS,
    ),
    "rule_flow_path": _sql(
        """SELECT CAST(date AS VARCHAR) AS date, campaignid, campaignname, rule_sequence, rulename, profiles_evaluated, total_actions,
                  addpoint_actions, points_awarded, profiles_not_matched,
                  CAST(total_profiles_evaluated - sum(total_actions) OVER (PARTITION BY date, campaignid
                       ORDER BY rule_sequence) AS BIGINT) AS remaining_profiles FROM flow""",
        "flow", dated=_ALL_DAYS,
    ),
    "daily_driving_events": _sql("SELECT * FROM driving", "driving"),
    "driving_messages": _sql("SELECT * FROM driving", "driving"),
    "daily_driving_events_day": _sql(f'SELECT * FROM driving WHERE "Date" = {EVENT_DAY // 1000}', "driving"),
    "verify_live_reports": _sql(
        f"""SELECT id, CASE WHEN due THEN 'Verified' ELSE status END AS status, submit_time,
                   CASE WHEN due THEN CAST({AS_OF} AS BIGINT) END AS last_modified,
                   CASE WHEN due THEN 'LiveReportVerificationJob' END AS last_modified_by
            FROM (SELECT *, status = 'WaitingVerification' AND submit_time <= {AS_OF - 300} AS due FROM live)""",
        "live",
    ),
    "release_batches": _sql("SELECT * FROM released", "released"),
    "release_live_reports": _sql(
        """SELECT batch_no, CAST(count(*) AS INTEGER) AS features, min(id) AS first_id, max(id) AS last_id,
                  any_value(total_records) AS total_records FROM released GROUP BY batch_no""",
        "released",
    ),
    "deduplicate": _sql("SELECT * FROM once", "once"),
    "deduplicate_month": _sql(
        f"""SELECT * FROM tx WHERE NOT ("Year" = 1998 AND "Month" = 6) UNION ALL
            SELECT * EXCLUDE (rn) FROM (SELECT *, {_NEWEST} AS rn FROM tx WHERE "Year" = 1998 AND "Month" = 6)
            WHERE rn = 1""",
        "tx",
    ),
    "duplicate_summary": _sql(
        """SELECT CAST(sum(copies) AS BIGINT) AS total_records, count(*) AS distinct_ids,
                  CAST(sum(copies) - count(*) AS BIGINT) AS potential_duplicates,
                  count(*) FILTER (WHERE copies > 1) AS duplicate_ids,
                  max(copies) FILTER (WHERE copies > 1) AS max_copies FROM copies""",
        "copies",
    ),
    "duplicate_distribution": _sql(
        "SELECT copies, count(*) AS ids FROM copies WHERE copies > 1 GROUP BY copies", "copies"
    ),
    "most_duplicated": _sql(
        'SELECT "Id", copies FROM copies WHERE copies > 1 ORDER BY copies DESC, "Id" LIMIT 5', "copies"
    ),
    "delete_period": _sql('SELECT * FROM tx WHERE NOT ("Year" = 1998 AND "Month" = 6)', "tx"),
    "deletion_report": _sql(
        """SELECT count(*) AS matched, count(*) AS deleted, CAST(0 AS BIGINT) AS remaining FROM tx
           WHERE "Year" = 1998 AND "Month" = 6""",
        "tx",
    ),
    "query_transactions": _sql(
        """SELECT "Id", "Phone", "Date", "Month", "Year", "EventCode", "ReportCode", "Name", "Value", "TimeStamp",
                  "MembershipCode", "Type" FROM tx
           ORDER BY "TimeStamp" DESC, "Id", "Phone", "Date", "Month", "Year", "EventCode", "ReportCode", "Name",
                    "Value", "MembershipCode", "Type" LIMIT 20""",
        "tx",
    ),
    "matching_transactions": _sql(
        """SELECT "Id", "Phone", "Date", "Month", "Year", "EventCode", "ReportCode", "Name", "Value", "TimeStamp",
                  "MembershipCode", "Type" FROM tx WHERE "Year" = 1998 AND "Month" = 6""",
        "tx",
    ),
    "insert_absent_by_id": _sql(
        """SELECT * FROM once_f UNION ALL
           SELECT * FROM once_o WHERE "Id" NOT IN (SELECT "Id" FROM once_f)""",
        "once_f", "once_o",
    ),
    "replace_rows_by_id": _sql(
        """SELECT * FROM once_o UNION ALL
           SELECT * FROM once_f WHERE "Id" NOT IN (SELECT "Id" FROM once_o)""",
        "once_f", "once_o",
    ),
    "ingest_events": _sql("SELECT * FROM ev", "ev"),
    "ingest_events_fill": _sql("SELECT * FROM ev", "ev"),
    "ingest_transactions": _sql(
        """SELECT * REPLACE (regexp_replace(md5('activity|' || "Id"), '^(.{8})(.{4})(.{4})(.{4})(.{12})$',
                  '\\1-\\2-\\3-\\4-\\5') AS "ActivityId") FROM once""",
        "once",
    ),
    "ingest_transactions_fill": _sql("""SELECT * REPLACE ('Other' AS "Type") FROM tx""", "tx"),
    "stream_points_month": _sql("SELECT * FROM monthly", "monthly"),
    "stream_points_year": _sql(
        """SELECT t.phone, c.membershipcode, 'Nhập môn' AS membershipname, t.year, CAST(9999 AS INTEGER) AS rank,
                  t.totalpoints, t.timestamp
           FROM (SELECT "Phone" AS phone, "Year" AS year, CAST(sum("Value") AS BIGINT) AS totalpoints,
                        max("TimeStamp") AS timestamp FROM scored GROUP BY ALL) t
           JOIN (SELECT "Phone" AS phone, "Year" AS year, "MembershipCode" AS membershipcode FROM (
                   SELECT *, row_number() OVER (PARTITION BY "Phone", "Year"
                          ORDER BY "TimeStamp" DESC, "MembershipCode" DESC) AS rn FROM scored) WHERE rn = 1) c
             ON t.phone = c.phone AND t.year = c.year""",
        "scored",
    ),
    "stream_points_all": _sql(
        """SELECT p."Id", p."Phone", p."TotalPoints" + coalesce(s.points, 0) AS "TotalPoints"
           FROM profile p LEFT JOIN (SELECT "Phone", CAST(sum("Value") AS BIGINT) AS points FROM scored
                                     GROUP BY "Phone") s ON p."Phone" = s."Phone" """,
        "profile",
    ),
    "register_users_monthly": f"""
        SELECT DISTINCT CAST(user_id AS VARCHAR) AS phone, 'Level1' AS membershipcode, 'Nhập môn' AS membershipname,
               CAST(1 AS INTEGER) AS month, CAST(2024 AS INTEGER) AS year, CAST(9999 AS INTEGER) AS rank,
               CAST(0 AS BIGINT) AS totalpoints, CAST({AS_OF * 1000} AS BIGINT) AS timestamp
        FROM events WHERE event_type = 'signup'""",
    "register_users_yearly": f"""
        SELECT DISTINCT CAST(user_id AS VARCHAR) AS phone, 'Level1' AS membershipcode, 'Nhập môn' AS membershipname,
               CAST(2024 AS INTEGER) AS year, CAST(9999 AS INTEGER) AS rank,
               CAST(0 AS BIGINT) AS totalpoints, CAST({AS_OF * 1000} AS BIGINT) AS timestamp
        FROM events WHERE event_type = 'signup'""",
    "stream_drop_repeats": _sql('SELECT DISTINCT "Id" FROM tx', "tx"),
    "stream_running_totals": _sql(
        """SELECT "Phone" AS phone, "Month" AS month, "Year" AS year, CAST(sum("Value") AS BIGINT) AS points,
                  max("TimeStamp") AS timestamp FROM scored GROUP BY ALL""",
        "scored",
    ),
}

_LOWER = ", ".join(
    f'"{name}" AS {name.lower()}'
    for name in (
        "Id", "Phone", "Date", "Month", "Year", "EventCode", "ReportCode", "ActivityId", "CampaignId", "RuleId",
        "CampaignName", "RuleName", "EventName", "ReportName", "MembershipCode", "Name", "Value", "TimeStamp", "Type",
    )
)
ORACLE["sync_missing"] = _sql(
    f"""SELECT {_LOWER} FROM tx WHERE "Id" NOT IN (SELECT "Id" FROM tx WHERE "Type" = 'F')""", "tx"
)
ORACLE["sync_missing_month"] = _sql(
    f"""SELECT {_LOWER} FROM (SELECT * FROM tx WHERE "Year" = 1998 AND "Month" = 6)
        WHERE "Id" NOT IN (SELECT "Id" FROM tx WHERE "Type" = 'F' AND "Year" = 1998 AND "Month" = 6)""",
    "tx",
)
# Batches, replays and new checkpoints change nothing.
ORACLE["ingest_transactions_batches"] = ORACLE["ingest_transactions"]
ORACLE["ingest_transactions_copy"] = (
    'SELECT "Id" AS id, "Phone" AS phone, "Year" AS year, "Month" AS month, "Value" AS value, "ActivityId" AS activityid '
    f'FROM ({ORACLE["ingest_transactions"]})'
)
ORACLE["ingest_transactions_documents"] = _sql(
    """SELECT DISTINCT "Id", "Year", "Month", 'Other' AS "Type" FROM tx""", "tx"
)
ORACLE["stream_points_batches"] = _sql("SELECT phone, year, month, totalpoints FROM monthly", "monthly")

# Stored tables that were changed in place hold what the plain queries give.
ORACLE["ingest_transactions_anywhere"] = ORACLE["ingest_transactions"]
ORACLE["verify_live_reports_stored"] = ORACLE["verify_live_reports"]
ORACLE["delete_period_stored"] = ORACLE["delete_period"]
ORACLE["deduplicate_month_stored"] = ORACLE["deduplicate_month"]
ORACLE["sync_missing_by_digest"] = _sql(
    f"""SELECT {_LOWER} FROM tx WHERE ("Id", "Year", "Month") NOT IN (SELECT "Id", "Year", "Month" FROM tx WHERE "Type" = 'F')""", "tx"
)
ORACLE["documents_replaced"] = _sql(
    """SELECT "Id", "Year", "Month", "Phone", "Value", "EventName", "TimeStamp" FROM (
           SELECT *, row_number() OVER (PARTITION BY "Id", "Year", "Month" ORDER BY batch DESC, "TimeStamp" DESC,
               "Phone" DESC, "Date" DESC, "EventCode" DESC, "ReportCode" DESC, "CampaignId" DESC, "RuleId" DESC,
               "CampaignName" DESC, "RuleName" DESC, "EventName" DESC, "ReportName" DESC, "MembershipCode" DESC,
               "Name" DESC, "Value" DESC NULLS LAST, "Type" DESC) AS rn
           FROM (SELECT *, CASE "Type" WHEN 'F' THEN 3 ELSE 1 END AS batch FROM tx UNION ALL
                 SELECT * REPLACE (NULL AS "Value", 'Corrected' AS "EventName", "TimeStamp" + 1 AS "TimeStamp"), 2 AS batch
                 FROM tx WHERE "Name" = 'AddPoint'))
       WHERE rn = 1""",
    "tx",
)
ORACLE["rank_after_changes"] = _sql(
    """SELECT id, phone, totalpoints, CAST(row_number() OVER (ORDER BY totalpoints DESC, phone) AS INTEGER) AS rank
       FROM (SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey AS VARCHAR) AS phone, coalesce(points, 0) AS totalpoints
             FROM customer LEFT JOIN (SELECT "Phone", CAST(sum("Value") AS BIGINT) AS points FROM scored GROUP BY "Phone")
               ON CAST(c_custkey AS VARCHAR) = "Phone")""",
    "scored",
)

# Documents and messages, every field read back from their text.
ORACLE["publish_monthly_documents"] = f'SELECT "Id" AS doc_id, * FROM ({ORACLE["publish_monthly"]})'
ORACLE["publish_yearly_documents"] = f'SELECT "Id" AS doc_id, * FROM ({ORACLE["publish_yearly"]})'
ORACLE["publish_profiles_documents"] = f"""SELECT 'profile:' || "Phone" AS doc_id, * FROM ({ORACLE["publish_profiles"]})"""
ORACLE["release_live_reports_messages"] = _sql(
    """SELECT batch_no, 'LiveReportV2' AS message_type, total_records, 'FeatureCollection' AS collection,
              CAST(row_number() OVER (PARTITION BY batch_no ORDER BY id) - 1 AS INTEGER) AS place, 'Feature' AS kind, 'Point' AS shape,
              lng, lat, id, value AS heading, expired_display_time AS "expiredDisplayTimeUnix", 'cell ' || user_id AS "cellId",
              CAST(hour(ts) AS INTEGER) AS "numberOfView", CAST(minute(ts) AS INTEGER) AS "numberOfConfirm",
              CAST(month(ts) AS INTEGER) AS "numberOfRejection", '#FF0000' AS "minimizationHexColor"
       FROM released JOIN events ON id = CAST(event_id AS VARCHAR)""",
    "released",
)
ORACLE["rule_flow_month"] = _sql(
    """SELECT * REPLACE (CAST(date AS VARCHAR) AS date), CAST(NULL AS BIGINT) AS timestamp FROM flow""",
    "flow", dated=_ALL_MONTHS,
)
ORACLE["rule_flow_month_bitmaps"] = ORACLE["rule_flow_month"]
