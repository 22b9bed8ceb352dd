"""Common table expressions over the order tables and a helper to compose them."""

from __future__ import annotations

import re

from oracle import values as c

FIRST, LAST, BACK = 199502, 200111, 199501
COMPONENTS = ", ".join(str(q) for q in c.COMPONENTS)
UNPROCESSED = ", ".join(str(q) for q in c.UNPROCESSED_QUESTIONS)
CLEAR = ", ".join(f"'{s}'" for s in c.CLEAR_STATUSES)
NIL = ", ".join(f"'{s}'" for s in c.NIL_STATUSES)
NON_RESPONSE = ", ".join(f"'{s}'" for s in c.NON_RESPONSE_STATUSES)


def xsum(expression: str, where: str | None = None) -> str:
    """Sum of amounts as whole numbers and billionths, added apart without loss."""
    tail = f" FILTER (WHERE {where})" if where else ""
    whole = f"TRUNC({expression})"
    return (f"(CAST(SUM(CAST({whole} AS BIGINT)){tail} AS DOUBLE) + CAST(SUM(CAST("
            f"FLOOR(({expression} - {whole}) * 1e9 + 0.5) AS BIGINT)){tail}"
            f" AS DOUBLE) / 1e9)")


def nation_pick(values, column: str, base: int) -> str:
    arms = " ".join(f"WHEN {i} THEN {v!r}" for i, v in enumerate(values))
    return f"CASE {column} % {base} {arms} END"


REGION_CODES = ("AA", "BA", "BB", "DC", "ED", "FE", "GF", "GG", "HH", "JG", "KJ", "WW", "XX")
CTES: dict[str, str] = {}

CTES["sv_raw"] = """
SELECT CAST(l_suppkey AS BIGINT) AS reference,
       CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT) AS period,
       CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INT) AS m,
       CASE l_linenumber WHEN 1 THEN 201 WHEN 2 THEN 202 WHEN 3 THEN 211 WHEN 4 THEN 212
            WHEN 5 THEN 221 WHEN 6 THEN 222 ELSE 232 END AS questioncode,
       SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount
FROM lineitem GROUP BY 1, 2, 3, 4"""

CTES["sv_units"] = f"""
SELECT CAST(s.s_suppkey AS BIGINT) AS reference, p.period AS period, p.m AS m,
       CASE (s.s_suppkey * 7 + p.m * 3) % 20
            WHEN 0 THEN 'Form sent out' WHEN 1 THEN 'Excluded from Results'
            WHEN 2 THEN 'Check needed' WHEN 3 THEN 'Clear - overridden'
            WHEN 4 THEN 'Dormant (NIL5)' ELSE 'Clear' END AS status,
       CASE (s.s_suppkey * 7 + p.m * 3) % 20
            WHEN 0 THEN 100 WHEN 1 THEN 100 WHEN 2 THEN 201 WHEN 3 THEN 211 ELSE 210
            END AS statusencoded,
       CAST(41000 + (s.s_nationkey % 14) * 100 AS VARCHAR) AS frosic2007,
       '0001' AS formtype,
       CAST((s.s_nationkey % 14) * 10 + 1 + s.s_suppkey % 7 AS INT) AS cell_no,
       CAST(s.s_suppkey % 90 + 10 AS INT) AS froempment,
       CAST(FLOOR(ABS(s.s_acctbal)) + 1 AS DOUBLE) AS frotover,
       {nation_pick(REGION_CODES, 's.s_nationkey', 13)} AS region,
       s.s_name AS runame1, s.s_name AS entname1
FROM supplier s CROSS JOIN (SELECT DISTINCT period, m FROM sv_raw) p"""

CTES["sv_contributors"] = "SELECT reference, period, status, statusencoded FROM sv_units"
CTES["sv_frame"] = "SELECT * EXCLUDE (m, status, statusencoded) FROM sv_units"

CTES["sv_responses"] = """
SELECT reference, period, questioncode, CAST(amount AS DOUBLE) AS adjustedresponse
FROM sv_raw WHERE (reference * 5 + m) % 17 > 1 AND (reference * 7 + m * 3) % 20 <> 0
UNION ALL
SELECT reference, period, 290,
       CAST(CASE WHEN (reference * 5 + m) % 17 = 1 THEN 0 ELSE SUM(amount) END AS DOUBLE)
FROM sv_raw WHERE (reference * 5 + m) % 17 <> 2 AND (reference * 7 + m * 3) % 20 <> 0
GROUP BY reference, period, m"""

CTES["sv_answers"] = f"""
SELECT *, CAST(CAST(TRUNC(adjustedresponse) AS BIGINT) AS VARCHAR) AS response,
       CASE WHEN period = {BACK} THEN 'r' END AS imputation_flags_adjustedresponse
FROM (
  SELECT * FROM sv_responses
  UNION ALL
  SELECT reference, period, q.questioncode,
         CASE q.questioncode
              WHEN 11 THEN CAST((reference + period // 100 * 12 + period % 100) % 28 + 1 AS DOUBLE)
              WHEN 146 THEN CASE WHEN (period // 100 * 12 + period % 100) % 2 = 0 THEN 1.0 END
              WHEN 902 THEN 1.0 END
  FROM (SELECT DISTINCT reference, period FROM sv_responses)
  CROSS JOIN (VALUES (11), (12), (146), (902)) q(questioncode))"""

CTES["sv_local_units"] = f"""
SELECT CAST(c.c_custkey % n.k AS BIGINT) AS reference, p.period AS period,
       CAST(FLOOR(ABS(c.c_acctbal)) AS BIGINT) % 100 AS employment,
       {nation_pick(REGION_CODES, 'c.c_nationkey', 13)} AS region
FROM customer c CROSS JOIN (SELECT COUNT(*) + 3 AS k FROM supplier) n
CROSS JOIN (SELECT DISTINCT period FROM sv_raw) p"""

CTES["sv_population"] = f"""
SELECT CAST(p_partkey AS BIGINT) AS reference, q.period AS period,
       CAST(CASE WHEN p_partkey % 11 = 0 THEN 5141
                 ELSE (p_partkey % 14) * 10 + 1 + p_partkey % 7 END AS INT) AS cell_no,
       CAST(FLOOR(p_retailprice) AS DOUBLE) AS frotover
FROM part CROSS JOIN (SELECT DISTINCT period FROM sv_raw WHERE period >= {FIRST}) q"""

CTES["sv_sample"] = f"SELECT reference, period FROM sv_units WHERE period <> {BACK}"

_CLASS = nation_pick(c.OUTPUT_CLASSIFICATIONS, "n_nationkey", 14)
CTES["sv_classifications"] = f"""
SELECT DISTINCT CAST(41000 + (n_nationkey % 14) * 100 AS VARCHAR) AS sic_5_digit,
       {_CLASS} AS classification FROM nation"""
CTES["sv_l_values"] = f"""
SELECT DISTINCT {_CLASS} AS classification, q.questioncode,
       CAST(((n_nationkey % 14) * 37 + q.questioncode) % 50 * 1000 AS DOUBLE) AS l_value
FROM nation CROSS JOIN (SELECT UNNEST([{COMPONENTS}]) AS questioncode) q
WHERE (n_nationkey % 14 + q.questioncode) % 5 <> 0"""

CTES["sv_manual"] = f"""
SELECT reference, period, 201 AS questioncode, frotover * 10 AS adjustedresponse
FROM sv_units WHERE status = 'Form sent out' AND froempment < 30 AND period <> {BACK}"""
CTES["sv_manual_weights"] = """
SELECT reference, period, 201 AS questioncode, 0.5 AS outlier_weight
FROM sv_units WHERE status = 'Clear - overridden' AND froempment >= 60"""
CTES["sv_link_filter"] = """
SELECT reference, period FROM sv_units WHERE status = 'Clear - overridden'"""
CTES["sv_regions"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{code}', '{name}')" for name, codes in c.REGIONS.items() for code in codes
) + ") t(region_code, region_name)"

# ---- staging -------------------------------------------------------------------------
CTES["o_kept"] = f"""
SELECT a.*, u.status, u.statusencoded FROM sv_answers a
LEFT JOIN sv_units u USING (reference, period)
WHERE NOT (a.period <> {BACK} AND COALESCE(u.status IN ({NON_RESPONSE}), FALSE))"""
CTES["o_good"] = f"""
SELECT * FROM o_kept WHERE questioncode NOT IN ({UNPROCESSED})
  AND NOT (period <> {BACK} AND COALESCE(statusencoded = 201, FALSE))"""
CTES["o_live"] = f"""
SELECT reference, period, questioncode, adjustedresponse AS live_adjustedresponse
FROM o_kept WHERE questioncode NOT IN ({UNPROCESSED})
  AND period <> {BACK} AND statusencoded = 201"""
CTES["o_pairs"] = f"""
SELECT reference, period,
       status IN ({CLEAR}) AND n_total > 0 AND (n_other = 0 OR (s_other = 0 AND s_total <> 0))
           AS total_only,
       status IN ({CLEAR}) AND n_other = 0 AND n_null = 0 AND s_total = 0 AS total_zero
FROM (SELECT reference, period, ANY_VALUE(status) AS status,
             COUNT(*) FILTER (WHERE questioncode = 290) AS n_total,
             COUNT(*) FILTER (WHERE questioncode <> 290) AS n_other,
             COUNT(*) FILTER (WHERE adjustedresponse IS NULL) AS n_null,
             COALESCE({xsum('adjustedresponse', 'questioncode = 290')}, 0) AS s_total,
             COALESCE({xsum('adjustedresponse', 'questioncode <> 290')}, 0) AS s_other
      FROM o_good GROUP BY reference, period)"""
# Questions a unit with answers stands for.
CTES["o_listed"] = f"""
SELECT g.reference, g.period, g.questioncode FROM o_good g
JOIN o_pairs p USING (reference, period) WHERE NOT p.total_only AND NOT p.total_zero
UNION
SELECT reference, period, q FROM o_pairs,
     (SELECT UNNEST([{COMPONENTS}, 290]) AS q) WHERE total_only OR total_zero"""
CTES["o_spine"] = """
SELECT u.reference, u.period, p.reference IS NOT NULL AS answered, p.total_only, p.total_zero,
       LAST_VALUE(CASE WHEN p.reference IS NOT NULL THEN u.period END IGNORE NULLS)
           OVER (PARTITION BY u.reference ORDER BY u.period
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_answer,
       LAST_VALUE(h.period IGNORE NULLS)
           OVER (PARTITION BY u.reference ORDER BY u.period
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_by_hand
FROM sv_units u LEFT JOIN o_pairs p USING (reference, period)
LEFT JOIN (SELECT DISTINCT reference, period FROM sv_manual) h USING (reference, period)"""
CTES["o_expected"] = f"""
SELECT s.reference, s.period, l.questioncode FROM o_spine s
JOIN o_listed l USING (reference, period)
WHERE s.answered AND (NOT s.total_zero OR l.questioncode = 290)
UNION
SELECT s.reference, s.period, l.questioncode FROM o_spine s
JOIN o_listed l ON l.reference = s.reference AND l.period = s.last_answer
WHERE NOT s.answered AND l.questioncode IN ({COMPONENTS})
UNION
SELECT s.reference, s.period, q FROM o_spine s, (SELECT UNNEST([{COMPONENTS}]) AS q)
WHERE NOT s.answered AND s.last_answer IS NULL
UNION
SELECT s.reference, s.period, h.questioncode FROM o_spine s
JOIN sv_manual h ON h.reference = s.reference AND h.period = s.last_by_hand
WHERE NOT s.answered"""
CTES["o_full"] = """
SELECT e.reference, e.period, e.questioncode,
       COALESCE(p.total_only, FALSE) AS "290_flag",
       COALESCE(p.total_zero, FALSE) AS is_total_only_and_zero,
       g.adjustedresponse, g.response, g.imputation_flags_adjustedresponse
FROM o_expected e LEFT JOIN o_pairs p USING (reference, period)
LEFT JOIN o_good g USING (reference, period, questioncode)"""
CTES["o_skipped"] = f"""
SELECT *, FALSE AS skipped_question FROM o_full
UNION ALL
SELECT u.reference, u.period, q, FALSE, NULL, 0, NULL, NULL, TRUE
FROM sv_units u, (SELECT UNNEST([{COMPONENTS}]) AS q)
WHERE u.status IN ({CLEAR}, {NIL})
  AND EXISTS (SELECT 1 FROM o_full f WHERE f.reference = u.reference AND f.period = u.period)
  AND NOT EXISTS (SELECT 1 FROM o_full f WHERE f.reference = u.reference
                  AND f.period = u.period AND f.questioncode = q)"""
CTES["o_staged"] = f"""
SELECT reference, period, questioncode, "290_flag", is_total_only_and_zero, status,
       statusencoded, frosic2007, formtype, cell_no, froempment, frotover, region, runame1,
       entname1, CASE WHEN NOT nulled THEN value END AS adjustedresponse, response,
       imputation_flags_adjustedresponse, skipped_question, live_adjustedresponse,
       frotover * 1000 / 12 AS converted_frotover,
       CAST((cell_no - 1) // 10 AS DOUBLE) AS imputation_class,
       nulled AS q290_component_set_null
FROM (SELECT *, COALESCE("290_flag" AND questioncode <> 290 AND value = 0
                         AND NOT skipped_question, FALSE) AS nulled
      FROM (SELECT s.*, u.* EXCLUDE (reference, period, m), l.live_adjustedresponse,
                   CASE WHEN u.status IN ({NIL}) THEN 0 ELSE s.adjustedresponse END AS value
            FROM o_skipped s JOIN sv_units u USING (reference, period)
            LEFT JOIN o_live l USING (reference, period, questioncode)))"""
CTES["o_unprocessed"] = f"""
SELECT k.reference, k.period, k.questioncode, k.adjustedresponse, k.response,
       k.imputation_flags_adjustedresponse, u.* EXCLUDE (reference, period, m)
FROM o_kept k LEFT JOIN sv_units u USING (reference, period)
WHERE k.questioncode IN ({UNPROCESSED}) AND k.questioncode NOT IN (902, 903, 904)"""

# ---- imputation ----------------------------------------------------------------------
CTES["o_months"] = """
SELECT s.*, (s.period // 100) * 12 + s.period % 100 AS m FROM o_staged s"""
CTES["o_matched"] = """
SELECT t.*, b.adjustedresponse AS before, a.adjustedresponse AS after,
       t.adjustedresponse IS NOT NULL AND b.adjustedresponse IS NOT NULL
           AS f_match_adjustedresponse,
       t.adjustedresponse IS NOT NULL AND a.adjustedresponse IS NOT NULL
           AS b_match_adjustedresponse,
       t.adjustedresponse IS NOT NULL AND t.converted_frotover IS NOT NULL
           AS flag_construction_matches
FROM o_months t
LEFT JOIN o_months b ON b.reference = t.reference AND b.questioncode = t.questioncode
                    AND b.m = t.m - 1
LEFT JOIN o_months a ON a.reference = t.reference AND a.questioncode = t.questioncode
                    AND a.m = t.m + 1"""
_LINKS = f"""
SELECT questioncode, imputation_class, period,
       COALESCE(f_top / NULLIF(f_bottom, 0), 1) AS f_link_adjustedresponse,
       f_top / NULLIF(f_bottom, 0) IS NULL AS default_link_f_match_adjustedresponse,
       COALESCE(b_top / NULLIF(b_bottom, 0), 1) AS b_link_adjustedresponse,
       b_top / NULLIF(b_bottom, 0) IS NULL AS default_link_b_match_adjustedresponse,
       COALESCE(c_top / NULLIF(c_bottom, 0), 1) AS construction_link,
       c_top / NULLIF(c_bottom, 0) IS NULL AS default_link_flag_construction_matches,
       f_match_adjustedresponse_count, b_match_adjustedresponse_count,
       flag_construction_matches_count
FROM (SELECT questioncode, imputation_class, period,
        COUNT(*) FILTER (WHERE f_match_adjustedresponse) AS f_match_adjustedresponse_count,
        COUNT(*) FILTER (WHERE b_match_adjustedresponse) AS b_match_adjustedresponse_count,
        COUNT(*) FILTER (WHERE flag_construction_matches) AS flag_construction_matches_count,
        {xsum('adjustedresponse', 'f_match_adjustedresponse')} AS f_top,
        {xsum('before', 'f_match_adjustedresponse')} AS f_bottom,
        {xsum('adjustedresponse', 'b_match_adjustedresponse')} AS b_top,
        {xsum('after', 'b_match_adjustedresponse')} AS b_bottom,
        {xsum('adjustedresponse', 'flag_construction_matches')} AS c_top,
        {xsum('converted_frotover', 'flag_construction_matches')} AS c_bottom
      FROM %s GROUP BY questioncode, imputation_class, period)"""
CTES["o_links"] = _LINKS % "o_matched"
CTES["o_filtered_links"] = _LINKS % """(SELECT t.* FROM o_matched t
      WHERE NOT EXISTS (SELECT 1 FROM sv_link_filter x
                        WHERE x.reference = t.reference AND x.period = t.period))"""
# Links of a run with a link filter: default links where it leaves nobody in a class.
CTES["o_filled_links"] = "SELECT questioncode, imputation_class, period, " + ", ".join(
    f"COALESCE(x.{name}, {default}) AS {name}" for name, default in (
        ("f_link_adjustedresponse", 1), ("default_link_f_match_adjustedresponse", "TRUE"),
        ("b_link_adjustedresponse", 1), ("default_link_b_match_adjustedresponse", "TRUE"),
        ("construction_link", 1), ("default_link_flag_construction_matches", "TRUE"),
        ("f_match_adjustedresponse_count", 0), ("b_match_adjustedresponse_count", 0),
        ("flag_construction_matches_count", 0))) + """
FROM o_links l LEFT JOIN o_filtered_links x USING (questioncode, imputation_class, period)"""
_UP = "PARTITION BY reference, questioncode ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_DOWN = _UP.replace("ORDER BY m", "ORDER BY m DESC")
CTES["o_chain"] = f"""
SELECT *,
       COUNT(anchor) OVER ({_UP}) AS f_run, COUNT(adjustedresponse) OVER ({_DOWN}) AS b_run,
       CASE WHEN period <> {BACK} THEN
            COUNT(*) FILTER (WHERE period <> {BACK}) OVER ({_UP}) END AS nth
FROM (SELECT t.* EXCLUDE (before, after), h.adjustedresponse AS adjustedresponse_man,
             l.* EXCLUDE (questioncode, imputation_class, period),
             COALESCE(t.adjustedresponse, h.adjustedresponse) AS anchor
      FROM o_matched t JOIN o_links l USING (questioncode, imputation_class, period)
      LEFT JOIN sv_manual h USING (reference, period, questioncode))"""
_F = "PARTITION BY reference, questioncode, f_run ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_B = "PARTITION BY reference, questioncode, b_run ORDER BY m DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
CTES["o_values"] = f"""
SELECT *,
       FIRST_VALUE(anchor) OVER ({_F})
         * list_aggregate(LIST(CASE WHEN anchor IS NOT NULL THEN 1.0::DOUBLE
                               ELSE f_link_adjustedresponse END) OVER ({_F}), 'product')
           AS forward_value,
       CASE WHEN f_run > 0 THEN FIRST_VALUE(
            CASE WHEN adjustedresponse IS NOT NULL THEN 'fir' ELSE 'fimc' END) OVER ({_F}) END
           AS forward_kind,
       FIRST_VALUE(adjustedresponse) OVER ({_B})
         * list_aggregate(LIST(CASE WHEN adjustedresponse IS NOT NULL THEN 1.0::DOUBLE
                               ELSE b_link_adjustedresponse END) OVER ({_B}), 'product')
           AS backward_value,
       CASE WHEN nth IS NOT NULL THEN
       MAX(CASE WHEN nth = 1 THEN converted_frotover * construction_link END)
           OVER (PARTITION BY reference, questioncode)
         * list_aggregate(LIST(CASE WHEN COALESCE(nth, 1) = 1 THEN 1.0::DOUBLE
                               ELSE f_link_adjustedresponse END) OVER ({_UP}), 'product') END
           AS constructed_value,
       CASE WHEN nth = 1 THEN 'c' WHEN nth > 1 THEN 'fic' END AS constructed_kind
FROM o_chain"""
CTES["o_rom"] = f"""
SELECT * EXCLUDE (m, anchor, f_run, b_run, nth, forward_value, forward_kind, backward_value,
                  constructed_value, constructed_kind)
       REPLACE (CASE WHEN adjustedresponse IS NOT NULL THEN adjustedresponse
                     WHEN adjustedresponse_man IS NOT NULL THEN adjustedresponse_man
                     WHEN forward_kind IS NOT NULL THEN forward_value
                     WHEN backward_value IS NOT NULL THEN backward_value
                     ELSE constructed_value END AS adjustedresponse,
                CASE WHEN adjustedresponse IS NOT NULL
                          THEN COALESCE(imputation_flags_adjustedresponse, 'r')
                     WHEN adjustedresponse_man IS NOT NULL THEN 'mc'
                     WHEN forward_kind IS NOT NULL THEN forward_kind
                     WHEN backward_value IS NOT NULL THEN 'bir'
                     ELSE constructed_kind END AS imputation_flags_adjustedresponse),
       period = {BACK} AS is_backdata
FROM o_values"""
_LINK_COLUMNS = (
    "f_link_adjustedresponse, default_link_f_match_adjustedresponse, b_link_adjustedresponse, "
    "default_link_b_match_adjustedresponse, construction_link, "
    "default_link_flag_construction_matches, f_match_adjustedresponse_count, "
    "b_match_adjustedresponse_count, flag_construction_matches_count")
_UNIT_COLUMNS = (
    "status, statusencoded, frosic2007, formtype, cell_no, froempment, frotover, region, "
    "runame1, entname1")
CTES["o_zeroed"] = f"""
SELECT reference, period, questioncode, "290_flag", is_total_only_and_zero, {_UNIT_COLUMNS},
       adjustedresponse, response, imputation_flags_adjustedresponse, skipped_question,
       converted_frotover, imputation_class, {_LINK_COLUMNS}, FALSE AS derived_zeros
FROM o_rom WHERE NOT is_backdata
UNION ALL
SELECT u.reference, u.period, q, FALSE, NULL, {_UNIT_COLUMNS}, 0, NULL, 'd', NULL,
       frotover * 1000 / 12, NULL, {', '.join(['NULL'] * 9)}, TRUE
FROM sv_units u, (SELECT UNNEST([{COMPONENTS}]) AS q)
WHERE u.period <> {BACK} AND u.status IN ('Check needed', {NON_RESPONSE})
  AND EXISTS (SELECT 1 FROM o_rom f WHERE f.reference = u.reference AND f.period = u.period)
  AND NOT EXISTS (SELECT 1 FROM o_rom f WHERE f.reference = u.reference
                  AND f.period = u.period AND f.questioncode = q)"""
CTES["o_rescaled"] = f"""
SELECT z.* REPLACE (CASE WHEN "290_flag" AND questioncode <> 290
                              AND s.total / NULLIF(s.parts, 0) IS NOT NULL
                         THEN s.total / s.parts * adjustedresponse
                         ELSE adjustedresponse END AS adjustedresponse),
       adjustedresponse AS adjustedresponse_pre_rescale,
       COALESCE(s.parts = 0 AND s.total <> 0, FALSE) AS failed_rescale
FROM o_zeroed z LEFT JOIN (
    SELECT reference, period,
           CASE WHEN COUNT(*) FILTER (WHERE questioncode = 290) > 0 THEN
                COALESCE({xsum('adjustedresponse', 'questioncode = 290')}, 0) END AS total,
           CASE WHEN COUNT(*) FILTER (WHERE questioncode <> 290) > 0 THEN
                COALESCE({xsum('adjustedresponse', 'questioncode <> 290')}, 0) END AS parts
    FROM o_zeroed WHERE "290_flag" GROUP BY reference, period) s USING (reference, period)"""
CTES["o_with_total"] = f"""
SELECT * FROM o_rescaled
UNION ALL BY NAME
SELECT DISTINCT u.reference, u.period, 290 AS questioncode, FALSE AS "290_flag",
       {_UNIT_COLUMNS}, 0 AS adjustedresponse,
       'd_create' AS imputation_flags_adjustedresponse
FROM sv_units u SEMI JOIN o_rescaled USING (reference, period)
WHERE NOT EXISTS (SELECT 1 FROM o_rescaled r WHERE r.reference = u.reference
                  AND r.period = u.period AND r.questioncode = 290)"""
CTES["o_imputed"] = f"""
SELECT *, CASE WHEN questioncode IN ({COMPONENTS}, 290) THEN adjustedresponse / 1000
               ELSE adjustedresponse END AS adjustedresponse_pounds_thousands
FROM (SELECT w.* REPLACE (
        CASE WHEN questioncode = 290 AND imputation_flags_adjustedresponse <> 'r'
             THEN COALESCE(s.parts, adjustedresponse) ELSE adjustedresponse END
             AS adjustedresponse,
        CASE WHEN questioncode = 290 AND imputation_flags_adjustedresponse <> 'r'
             THEN 'd' ELSE imputation_flags_adjustedresponse END
             AS imputation_flags_adjustedresponse)
      FROM o_with_total w LEFT JOIN (
        SELECT reference, period, COALESCE({xsum('adjustedresponse')}, 0) AS parts
        FROM o_with_total
        WHERE questioncode <> 290 AND imputation_flags_adjustedresponse IS DISTINCT FROM 'r'
          AND "290_flag" = FALSE
        GROUP BY reference, period) s USING (reference, period))"""

# ---- estimation ----------------------------------------------------------------------
CTES["o_counts"] = f"""
SELECT p.period, p.cell_no, {xsum('p.frotover')} AS population_turnover_sum,
       COUNT(*) AS population_count,
       {xsum('p.frotover', 's.reference IS NOT NULL')} AS sample_turnover_sum,
       COUNT(s.reference) AS sample_count
FROM sv_population p LEFT JOIN sv_sample s USING (reference, period)
GROUP BY p.period, p.cell_no"""
CTES["o_cells"] = """
SELECT *, population_turnover_sum / NULLIF(design_weight * sample_turnover_sum, 0)
          AS calibration_factor,
       COALESCE(design_weight = 1, FALSE) AS is_census
FROM (SELECT *, CASE WHEN cell_no = 5141 THEN 1.0 ELSE
                CAST(population_count AS DOUBLE) / NULLIF(sample_count, 0) END AS design_weight
      FROM o_counts)"""
CTES["o_weighted"] = """
SELECT i.*, w.design_weight, w.calibration_factor, w.is_census,
       s.reference IS NOT NULL AS is_sampled
FROM o_imputed i
LEFT JOIN (sv_sample s JOIN sv_population p USING (reference, period)
           JOIN o_cells w ON w.period = p.period AND w.cell_no = p.cell_no)
  ON s.reference = i.reference AND s.period = i.period"""

# ---- outliers ------------------------------------------------------------------------
CTES["o_valued"] = """
SELECT w.*, k.classification, v.l_value FROM o_weighted w
LEFT JOIN sv_classifications k ON k.sic_5_digit = w.frosic2007
LEFT JOIN sv_l_values v ON v.classification = k.classification
                       AND v.questioncode = w.questioncode"""
CTES["o_winsorised"] = f"""
SELECT * EXCLUDE (ratio),
       CASE WHEN questioncode = 290 THEN NULL WHEN nw_ag_flag OR adjustedresponse = 0 THEN 1
            ELSE new_target_variable / NULLIF(adjustedresponse, 0) END AS outlier_weight
FROM (SELECT *, CASE WHEN nw_ag_flag THEN adjustedresponse
                     WHEN adjustedresponse <= ratio_estimation_treshold THEN adjustedresponse
                     WHEN ratio_estimation_treshold IS NOT NULL THEN
                       adjustedresponse / (design_weight * calibration_factor)
                       + (1 - 1 / (design_weight * calibration_factor))
                         * ratio_estimation_treshold END AS new_target_variable
      FROM (SELECT *, CASE WHEN NOT nw_ag_flag THEN predicted_unit_value + l_value
                            / (design_weight * calibration_factor - 1) END
                      AS ratio_estimation_treshold
            FROM (SELECT v.*, r.ratio,
                         COALESCE(v.is_census, FALSE)
                           OR COALESCE(v.design_weight * v.calibration_factor <= 1, FALSE)
                           AS nw_ag_flag,
                         v.frotover * r.ratio AS predicted_unit_value
                  FROM o_valued v LEFT JOIN (
                    SELECT questioncode, period, cell_no,
                           {xsum('design_weight * adjustedresponse')}
                           / NULLIF({xsum('design_weight * frotover')}, 0) AS ratio
                    FROM o_valued WHERE questioncode <> 290
                    GROUP BY questioncode, period, cell_no) r
                  USING (questioncode, period, cell_no))))"""
CTES["o_total_weights"] = f"""
SELECT w.* REPLACE (
         CASE WHEN questioncode <> 290 THEN outlier_weight
              WHEN s.untrimmed OR outlier_weight = 1 THEN 1
              ELSE s.kept / NULLIF(adjustedresponse, 0) END AS outlier_weight)
FROM o_winsorised w LEFT JOIN (
    SELECT reference, period,
           SUM(CAST(outlier_weight AS DECIMAL(28,9))) = COUNT(outlier_weight) AS untrimmed,
           COALESCE({xsum('outlier_weight * adjustedresponse')}, 0) AS kept
    FROM o_winsorised WHERE questioncode IN ({COMPONENTS})
    GROUP BY reference, period) s USING (reference, period)"""
CTES["o_trimmed"] = """
SELECT *, outlier_weight * adjustedresponse AS winsorised_value
FROM (SELECT t.* REPLACE (COALESCE(h.outlier_weight, t.outlier_weight) AS outlier_weight)
      FROM o_total_weights t LEFT JOIN sv_manual_weights h
      USING (reference, period, questioncode))"""

# ---- results -------------------------------------------------------------------------
RESULT_COLUMNS = """reference, period, frosic2007, classification, cell_no, frotover,
 froempment, formtype, questioncode, statusencoded, design_weight, calibration_factor,
 outlier_weight, imputation_flags_adjustedresponse, imputation_class, f_link_adjustedresponse,
 default_link_f_match_adjustedresponse, b_link_adjustedresponse,
 default_link_b_match_adjustedresponse, construction_link, flag_construction_matches_count,
 default_link_flag_construction_matches, adjustedresponse, adjustedresponse_pounds_thousands,
 response, status, runame1, entname1, region, winsorised_value, "290_flag", derived_zeros,
 b_match_adjustedresponse_count, f_match_adjustedresponse_count"""
CTES["o_results"] = f"""
SELECT {RESULT_COLUMNS} FROM (
  SELECT * REPLACE (CAST(classification AS VARCHAR) AS classification) FROM o_trimmed
  UNION ALL BY NAME SELECT * FROM o_unprocessed)"""
CTES["o_thousands"] = f"""
SELECT * REPLACE (CASE WHEN questioncode IN ({UNPROCESSED}) THEN adjustedresponse
                       ELSE adjustedresponse_pounds_thousands END AS adjustedresponse),
       adjustedresponse AS adjustedresponse_actual
FROM o_results"""

_NAMES = re.compile(r"\b(?:sv|o)_\w+\b")


def _needed(sql: str, order: list[str], views: dict[str, str]) -> None:
    for name in dict.fromkeys(_NAMES.findall(sql)):
        if name in views and name not in order:
            _needed(views[name], order, views)
            order.append(name)


def statement(sql: str, views: dict[str, str] = CTES) -> str:
    """``sql`` with the common table expressions it needs."""
    order: list[str] = []
    _needed(sql, order, views)
    if not order:
        return sql
    head = ",\n".join(f"{name} AS MATERIALIZED ({views[name]})" for name in order)
    return f"WITH {head}\n{sql}"
