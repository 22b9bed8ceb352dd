"""One SQL statement per named query."""

from __future__ import annotations

from oracle import values as c
from oracle.values import month_label
from oracle.views import (
    BACK, CLEAR, COMPONENTS, CTES, NIL, NON_RESPONSE, RESULT_COLUMNS, UNPROCESSED, statement,
    xsum,
)

KEY = "reference, period, questioncode"
PERIODS = c.periods(BACK, 83)[1:]
QUARTER = "period // 100 || 'Q' || (period % 100 + 2) // 3"
GROSS = "{} * design_weight * outlier_weight * calibration_factor"
TARGET_GROSS = GROSS.format("adjustedresponse")
THOUSANDS_GROSS = GROSS.format("adjustedresponse_pounds_thousands")


# ---- legacy views --------------------------------------------------------------------
CTES["sv_legacy_questions"] = """
SELECT *, CASE question_no WHEN 290 THEN 2 WHEN 211 THEN 3 ELSE 1 END AS type FROM (
SELECT reference, period, questioncode AS question_no, adjustedresponse AS returned_value,
       CASE WHEN (reference + (period // 100) * 12 + period % 100) % 3 = 0
                 AND questioncode IN (201, 202, 211, 212)
            THEN 0 ELSE adjustedresponse END AS adjusted_value
FROM sv_responses
UNION ALL
SELECT reference, period, q, v, v FROM (
  SELECT reference, period, 902 AS q,
         CAST((reference + (period // 100) * 12 + period % 100) % 2 + 1 AS DOUBLE) AS v
  FROM (SELECT DISTINCT reference, period FROM sv_responses)
  UNION ALL
  SELECT reference, period, 903,
         CAST((reference + (period // 100) * 12 + period % 100) % 5 % 2 + 1 AS DOUBLE)
  FROM (SELECT DISTINCT reference, period FROM sv_responses)
  UNION ALL
  SELECT reference, period, 904,
         CAST((reference + (period // 100) * 12 + period % 100) % 7 % 2 + 1 AS DOUBLE)
  FROM (SELECT DISTINCT reference, period FROM sv_responses)
  WHERE ((period // 100) * 12 + period % 100) % 4 > 0))"""
CTES["sv_legacy_units"] = """
SELECT reference, period,
       CASE status WHEN 'Check needed' THEN 'E' WHEN 'Clear - overridden' THEN 'O'
            ELSE 'C' END AS error_mkr,
       CASE status WHEN 'Dormant (NIL5)' THEN 5 ELSE 1 END AS response_type
FROM sv_units"""
CTES["o_legacy_status"] = """
SELECT reference, period,
       CASE error_mkr WHEN 'E' THEN 'Check needed' WHEN 'O' THEN 'Clear - overridden'
            ELSE 'Clear' END AS status,
       CASE error_mkr WHEN 'E' THEN 201 WHEN 'O' THEN 211 ELSE 210 END AS statusencoded
FROM sv_legacy_units"""
CTES["sv_mixed"] = """
SELECT reference, period, question_no AS questioncode, adjusted_value AS adjustedresponse
FROM sv_legacy_questions WHERE question_no NOT IN (902, 903, 904)"""
CTES["o_routed"] = """
SELECT q.* FROM sv_legacy_questions q
LEFT JOIN (SELECT reference, period,
       SUM(adjusted_value) FILTER (WHERE question_no IN (201, 202, 211, 212)) AS s902,
       SUM(adjusted_value) FILTER (WHERE question_no IN (221, 222)) AS s903,
       SUM(adjusted_value) FILTER (WHERE question_no IN (231, 232, 241, 242, 243)) AS s904,
       MAX(CASE WHEN question_no = 902 THEN adjusted_value END) AS a902,
       MAX(CASE WHEN question_no = 903 THEN adjusted_value END) AS a903,
       MAX(CASE WHEN question_no = 904 THEN adjusted_value END) AS a904
     FROM sv_legacy_questions GROUP BY reference, period) r USING (reference, period)
WHERE NOT (question_no IN (201, 202, 211, 212) AND COALESCE(s902, 0) = 0
           AND (a902 IS NULL OR a902 = 2))
  AND NOT (question_no IN (221, 222) AND COALESCE(s903, 0) = 0
           AND (a903 IS NULL OR a903 = 2))
  AND NOT (question_no IN (231, 232, 241, 242, 243) AND COALESCE(s904, 0) = 0
           AND (a904 IS NULL OR a904 = 2))"""

# ---- K1 and K2 over the plain responses, without freezing -----------------------------
def flags(source: str) -> str:
    return f"""
SELECT reference, period,
       COALESCE(status IN ({CLEAR}) AND n_total > 0
         AND (n_other = 0 OR (s_other = 0 AND s_total <> 0)), FALSE) AS total_only,
       COALESCE(status IN ({CLEAR}) AND n_other = 0 AND n_null = 0 AND s_total = 0, FALSE)
         AS total_zero
FROM (SELECT r.reference, r.period, ANY_VALUE(u.status) AS status,
             COUNT(*) FILTER (WHERE questioncode = 290) AS n_total,
             COUNT(*) FILTER (WHERE questioncode <> 290) AS n_other,
             COUNT(*) FILTER (WHERE adjustedresponse IS NULL) AS n_null,
             COALESCE({xsum('adjustedresponse', 'questioncode = 290')}, 0) AS s_total,
             COALESCE({xsum('adjustedresponse', 'questioncode <> 290')}, 0) AS s_other
      FROM {source} r LEFT JOIN sv_units u USING (reference, period)
      GROUP BY r.reference, r.period)"""


CTES["o_mixed_flags"] = flags("sv_mixed")
CTES["o_plain"] = f"""
SELECT r.* FROM sv_responses r JOIN sv_units u USING (reference, period)
WHERE u.status NOT IN ({NON_RESPONSE})"""
CTES["o_plain_flags"] = flags("o_plain")
CTES["o_plain_listed"] = f"""
SELECT r.reference, r.period, r.questioncode FROM o_plain r
JOIN o_plain_flags f USING (reference, period) WHERE NOT total_only AND NOT total_zero
UNION SELECT reference, period, q FROM o_plain_flags,
      (SELECT UNNEST([{COMPONENTS}, 290]) AS q) WHERE total_only OR total_zero"""
_SPAN = ("OVER (PARTITION BY u.reference ORDER BY u.period "
         "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
CTES["o_plain_spine"] = f"""
SELECT u.reference, u.period, f.reference IS NOT NULL AS answered, f.total_only,
       f.total_zero,
       LAST_VALUE(CASE WHEN f.reference IS NOT NULL THEN u.period END IGNORE NULLS) {_SPAN}
           AS last_answer,
       LAST_VALUE(h.period IGNORE NULLS) {_SPAN} AS last_by_hand
FROM sv_units u LEFT JOIN o_plain_flags f USING (reference, period)
LEFT JOIN (SELECT DISTINCT reference, period FROM sv_manual) h USING (reference, period)"""


def expected(by_hand: bool) -> str:
    hand = """
UNION SELECT s.reference, s.period, h.questioncode FROM o_plain_spine s
JOIN sv_manual h ON h.reference = s.reference AND h.period = s.last_by_hand
WHERE NOT s.answered""" if by_hand else ""
    return f"""
SELECT e.*, COALESCE(f.total_only, FALSE) AS "290_flag",
       COALESCE(f.total_zero, FALSE) AS is_total_only_and_zero, r.adjustedresponse
FROM (
  SELECT s.reference, s.period, l.questioncode FROM o_plain_spine s
  JOIN o_plain_listed l USING (reference, period)
  WHERE s.answered AND (NOT s.total_zero OR l.questioncode = 290)
  UNION SELECT s.reference, s.period, l.questioncode FROM o_plain_spine s
  JOIN o_plain_listed l ON l.reference = s.reference AND l.period = s.last_answer
  WHERE NOT s.answered AND l.questioncode IN ({COMPONENTS})
  UNION SELECT s.reference, s.period, q FROM o_plain_spine s,
        (SELECT UNNEST([{COMPONENTS}]) AS q)
  WHERE NOT s.answered AND s.last_answer IS NULL{hand}
) e LEFT JOIN o_plain_flags f USING (reference, period)
LEFT JOIN o_plain r USING (reference, period, questioncode)"""


CTES["o_plain_expected"] = expected(False)

# ---- outputs -------------------------------------------------------------------------
CTES["o_suffixed"] = """
SELECT r.* REPLACE (
  CASE WHEN COALESCE(f.hit, FALSE) AND questioncode <> 290
            AND imputation_flags_adjustedresponse NOT IN ('r', 'c', 'mc')
       THEN imputation_flags_adjustedresponse || '_c'
       ELSE imputation_flags_adjustedresponse END AS imputation_flags_adjustedresponse)
FROM o_results r LEFT JOIN (
  SELECT reference, period, BOOL_OR("290_flag") AS hit FROM o_results
  GROUP BY reference, period) f USING (reference, period)"""
CTES["o_renamed"] = """
SELECT * REPLACE (CASE WHEN derived_zeros THEN 'fir' ELSE imputation_flags_adjustedresponse
                  END AS imputation_flags_adjustedresponse) FROM %s"""
for _name, _source in (("o_fir", "o_results"), ("o_suffixed_fir", "o_suffixed"),
                       ("o_thousands_fir", "o_thousands")):
    CTES[_name] = CTES["o_renamed"] % _source
del CTES["o_renamed"]


def qa(source: str, questions) -> str:
    cells = []
    for q in questions:
        for measure, value in (
                ("adjustedresponse", "adjustedresponse_pounds_thousands"),
                ("imputation_flags_adjustedresponse", "imputation_flags_adjustedresponse"),
                ("outlier_weight", "outlier_weight"),
                ("weighted_adjusted_value", f"{THOUSANDS_GROSS}")):
            cells.append(f'MAX(CASE WHEN questioncode = {q} THEN {value} END) '
                         f'AS "{q}__{measure}"')
    return f"""
SELECT period, frosic2007, reference, cell_no, frotover, froempment, runame1,
       {', '.join(cells)}, MAX(design_weight) AS design_weight,
       MAX(calibration_factor) AS calibration_factor, MAX(status) AS status
FROM {source}
WHERE period IS NOT NULL AND frosic2007 IS NOT NULL AND reference IS NOT NULL
  AND cell_no IS NOT NULL AND frotover IS NOT NULL AND froempment IS NOT NULL
  AND runame1 IS NOT NULL
GROUP BY period, frosic2007, reference, cell_no, frotover, froempment, runame1"""


CTES["o_bands"] = """
SELECT *, CAST(classification AS INT) AS class_no, cell_no % 10 AS sizeband
FROM o_thousands WHERE classification IS NOT NULL AND cell_no IS NOT NULL"""


def growth(source: str, periods) -> str:
    months = ", ".join(
        f'COALESCE({xsum(TARGET_GROSS, f"period = {p}")}, 0) AS "{month_label(p)}"'
        for p in periods)
    names = ", ".join(f'COALESCE(s."{month_label(p)}", 0) AS "{month_label(p)}"'
                      for p in periods)
    return f"""
SELECT k.class_no AS classification, q.questioncode, b.sizeband, {names}
FROM (SELECT DISTINCT class_no FROM {source}) k
CROSS JOIN (SELECT DISTINCT questioncode FROM {source}) q
CROSS JOIN (SELECT DISTINCT sizeband FROM {source}) b
LEFT JOIN (SELECT class_no, questioncode, sizeband, {months} FROM {source}
           GROUP BY class_no, questioncode, sizeband) s
  ON s.class_no = k.class_no AND s.questioncode = q.questioncode
 AND s.sizeband = b.sizeband"""


CTES["o_component_bands"] = f"SELECT * FROM o_bands WHERE questioncode IN ({COMPONENTS})"
CTES["o_cord_growth"] = growth("o_component_bands", PERIODS)
_LETTERS = " ".join(f"WHEN {k} THEN '{v}'" for k, v in c.SIZE_BAND_LETTERS.items())
_CLASSES = ", ".join(str(k) for k in c.OUTPUT_CLASSIFICATIONS)
CORD = f"""
SELECT * REPLACE (CASE sizeband {_LETTERS} END AS sizeband) FROM o_cord_growth
UNION ALL
SELECT k, q, letter, {', '.join(['0'] * len(PERIODS))}
FROM (SELECT UNNEST([{_CLASSES}]) AS k), (SELECT UNNEST([{COMPONENTS}]) AS q),
     (SELECT UNNEST(['A', 'B', 'C', 'D', 'E', 'F', 'G']) AS letter)
WHERE letter NOT IN (SELECT CASE sizeband {_LETTERS} END FROM o_cord_growth)"""

CTES["o_quarters"] = f"""
SELECT *, {QUARTER} AS quarter, cell_no % 10 AS sizeband FROM o_thousands
WHERE questioncode IN ({COMPONENTS})"""
SIZEBAND = f"""
SELECT q.quarter, b.sizeband, {', '.join(f'COALESCE(s."{q}", 0) AS "{q}"' for q in c.COMPONENTS)}
FROM (SELECT DISTINCT quarter FROM o_quarters) q
CROSS JOIN (SELECT DISTINCT sizeband FROM o_quarters) b
LEFT JOIN (SELECT quarter, sizeband, {', '.join(
    f'{xsum(TARGET_GROSS, f"questioncode = {q}")} AS "{q}"' for q in c.COMPONENTS)}
  FROM o_quarters GROUP BY quarter, sizeband) s
  ON s.quarter = q.quarter AND s.sizeband = b.sizeband"""

CTES["o_contribution"] = f"""
SELECT questioncode,
       COALESCE({xsum(GROSS.format('(adjustedresponse / 1000)'),
                      "imputation_flags_adjustedresponse = 'r'")}, 0) AS returned,
       COALESCE({xsum(GROSS.format('(adjustedresponse / 1000)'),
                      "imputation_flags_adjustedresponse IN ('fir','bir','mc','fimc','fic','c')"
                      )}, 0) AS imputed
FROM o_thousands WHERE questioncode IN ({COMPONENTS}) GROUP BY ROLLUP (questioncode)"""


def region_list(codes) -> str:
    return ", ".join(f"'{code}'" for code in codes)


CTES["o_shares"] = "SELECT reference, period, " + ", ".join(
    f'CAST(SUM(employment) FILTER (WHERE region IN ({region_list(codes)})) AS DOUBLE)'
    f' / NULLIF(SUM(employment), 0) AS "percentage_{name}"'
    for name, codes in c.REGIONS.items()) + " FROM sv_local_units GROUP BY reference, period"
CTES["o_filled"] = f"""
SELECT r.reference, r.period, r.questioncode, r.region,
       {GROSS.format('r.adjustedresponse_pounds_thousands')} AS gross_turnover_uk, """ + ", ".join(
    f'CASE WHEN s."percentage_{name}" IS NULL AND r.region IN ({region_list(codes)}) THEN 1 '
    f'ELSE s."percentage_{name}" END AS "percentage_{name}"'
    for name, codes in c.REGIONS.items()) + """
FROM o_results r LEFT JOIN o_shares s USING (reference, period)
WHERE r.questioncode IN (202, 212, 222, 232, 243)"""
CTES["o_long_turnover"] = " UNION ALL ".join(
    f"""SELECT reference, period, questioncode, {QUARTER} AS quarter, '{name}' AS region,
       "percentage_{name}" * gross_turnover_uk AS turnover FROM o_filled"""
    for name in c.REGIONS)


def repair(where: str) -> str:
    cells = ", ".join(
        f'COALESCE({xsum("turnover", f"questioncode = {q}")}, 0) AS {name}'
        for q, name in c.REPAIR_QUESTIONS.items())
    return f"""SELECT quarter, region, {cells} FROM o_long_turnover
WHERE {where} GROUP BY quarter, region"""


def flag_query(flag: str, name: str) -> str:
    return f"""SELECT m.*, f.{flag} AS {name} FROM sv_mixed m
JOIN o_mixed_flags f USING (reference, period)"""


FRAME = """reference, period, frosic2007, formtype, cell_no, froempment, frotover, region,
 runame1, entname1"""

SNAPSHOT = """
SELECT reference, period, status, statusencoded, NULL AS questioncode, NULL AS response,
       NULL AS adjustedresponse FROM sv_contributors
UNION ALL
SELECT reference, period, NULL, NULL, questioncode, response, adjustedresponse FROM sv_answers"""

_SQL: dict[str, str] = {
    # sources and sinks
    "src_snapshot_records": SNAPSHOT,
    "src_snapshot_columnar": SNAPSHOT,
    "src_csv": "SELECT * FROM sv_manual",
    "src_colon": f"SELECT {FRAME} FROM sv_frame",
    "src_frame_window":
        f"SELECT {FRAME} FROM sv_frame WHERE period BETWEEN 200010 AND 200111",
    "src_local_units":
        "SELECT * FROM sv_local_units WHERE period BETWEEN 200106 AND 200111",
    "enforce_types": f"SELECT {KEY}, adjustedresponse FROM sv_responses",
    "append_back_data": f"""
SELECT {KEY}, adjustedresponse, NULL AS imputation_flags_adjustedresponse
FROM sv_answers WHERE period <> {BACK}
UNION ALL
SELECT reference, period, question_no, adjusted_value,
       CASE type WHEN 1 THEN 'r' WHEN 3 THEN 'fir' END
FROM sv_legacy_questions WHERE period = {BACK} AND type <> 2
UNION ALL BY NAME
SELECT reference, period, status, statusencoded FROM sv_contributors WHERE period <> {BACK}
UNION ALL BY NAME
SELECT reference, period, status, statusencoded FROM o_legacy_status WHERE period = {BACK}""",
    "legacy_to_panel": """
SELECT reference, period,
       CASE error_mkr WHEN 'E' THEN 'Check needed' WHEN 'O' THEN 'Clear - overridden'
            ELSE 'Clear' END AS status,
       CASE error_mkr WHEN 'E' THEN 201 WHEN 'O' THEN 211 ELSE 210 END AS statusencoded,
       response_type FROM sv_legacy_units""",
    "join_sample": """
SELECT u.reference, u.period, u.status, u.statusencoded, u.cell_no AS cellnumber,
       '0' || u.formtype AS formtype, u.froempment AS frozenemployees,
       u.frosic2007 AS frozensic, u.frotover AS frozenturnover FROM sv_units u""",
    "legacy_snapshot": """
SELECT q.reference, q.period, q.question_no AS questioncode,
       q.returned_value AS response, q.adjusted_value AS adjustedresponse
FROM o_routed q JOIN sv_legacy_units u USING (reference, period)
WHERE q.question_no NOT IN (902, 903, 904) AND u.response_type <> 5
UNION ALL BY NAME
SELECT reference, period, s.status, s.statusencoded, u.cell_no AS cellnumber,
       '0' || u.formtype AS formtype, u.froempment AS frozenemployees,
       u.frosic2007 AS frozensic, u.frotover AS frozenturnover
FROM o_legacy_status s JOIN sv_units u USING (reference, period)""",
    "sink_csv": SIZEBAND,
    "sink_stage": "SELECT * FROM sv_answers",
    "src_results": f"""
SELECT {KEY}, imputation_flags_adjustedresponse, adjustedresponse
FROM o_results""",
    # row rules
    "split_questions": f"""
SELECT reference, period, question_no AS questioncode, adjusted_value AS adjustedresponse,
       question_no NOT IN ({UNPROCESSED}) AS processed FROM sv_legacy_questions""",
    "results_projection": f"""
SELECT {RESULT_COLUMNS} FROM (
  SELECT * REPLACE (CAST(classification AS VARCHAR) AS classification) FROM o_trimmed)""",
    "revised_results": f"""
SELECT {KEY}, imputation_flags_adjustedresponse,
       CASE WHEN period IN (200110, 200111) THEN adjustedresponse * 2
            ELSE adjustedresponse END AS adjustedresponse
FROM o_results WHERE period <> {BACK}""",
    "masked_replace": f"""
SELECT {KEY}, CASE WHEN adjustedresponse >= 10000 THEN adjustedresponse END
       AS adjustedresponse FROM sv_responses""",
    "null_total_only_components": f"""
SELECT {KEY}, CASE WHEN NOT hit THEN adjustedresponse END AS adjustedresponse,
       total_only AS "290_flag", FALSE AS skipped_question, hit AS q290_component_set_null
FROM (SELECT m.*, f.total_only,
             f.total_only AND questioncode <> 290 AND adjustedresponse = 0 AS hit
      FROM sv_mixed m JOIN o_mixed_flags f USING (reference, period))""",
    "nil_to_zero": f"""
SELECT {KEY}, status, CASE WHEN status IN ({NIL}) THEN 0 ELSE adjustedresponse END
       AS adjustedresponse FROM sv_responses JOIN sv_units USING (reference, period)""",
    "annual_to_monthly":
        "SELECT reference, period, frotover * 1000 / 12 AS converted_frotover FROM sv_units",
    "pounds_thousands": f"""
SELECT *, CASE WHEN questioncode IN ({COMPONENTS}, 290) THEN adjustedresponse / 1000
               ELSE adjustedresponse END AS adjustedresponse_pounds_thousands
FROM sv_responses""",
    "derived_zeros": f"""
SELECT {KEY}, status, cell_no, derived_zeros, skipped_question, "290_flag",
       adjustedresponse FROM o_zeroed""",
    "mark_derived_zeros":
        f"SELECT {KEY}, imputation_flags_adjustedresponse, derived_zeros FROM o_zeroed",
    "refill_auxiliary": f"SELECT {KEY}, converted_frotover FROM o_zeroed",
    "derived_to_fir": f"SELECT {KEY}, imputation_flags_adjustedresponse FROM o_fir",
    "target_in_thousands": f"""
SELECT {KEY}, adjustedresponse, adjustedresponse_actual
FROM o_thousands""",
    "grossed_value": f"SELECT {KEY}, {THOUSANDS_GROSS} AS grossed FROM o_results",
    "check_nonresponse_in_responses": f"""
SELECT DISTINCT u.reference, u.period FROM sv_units u JOIN sv_responses r
USING (reference, period) WHERE u.status IN ({NON_RESPONSE})""",
    # joins and panel
    "panel_full_outer": f"""
SELECT COALESCE(a.reference, b.reference) AS reference, COALESCE(a.period, b.period) AS period,
       a.n_questions, a.region AS region_contributor, b.cell_no, b.region AS region_frame
FROM (SELECT reference, period, COUNT(*) AS n_questions, 'returned' AS region
      FROM sv_raw GROUP BY reference, period) a
FULL JOIN (SELECT * FROM sv_frame WHERE period <> {BACK}) b
  ON a.reference = b.reference AND a.period = b.period""",
    "attach_contributors": """
SELECT r.*, u.status, u.statusencoded FROM sv_responses r
LEFT JOIN sv_units u USING (reference, period)""",
    "frozen_split": f"""
SELECT {KEY}, CASE WHEN NOT err THEN adjustedresponse END AS adjustedresponse,
       CASE WHEN err THEN adjustedresponse END AS live_adjustedresponse
FROM (SELECT r.*, u.statusencoded = 201 AND r.period <> {BACK} AS err
      FROM sv_responses r JOIN sv_units u USING (reference, period))""",
    "live_passthrough": """
SELECT *, CAST(NULL AS DOUBLE) AS live_adjustedresponse FROM sv_responses""",
    "exclude_nonresponse": "SELECT * FROM o_plain",
    "excluded_report": f"""
SELECT {KEY}, status, adjustedresponse FROM sv_responses
JOIN sv_units USING (reference, period) WHERE status IN ({NON_RESPONSE})""",
    "join_l_values":
        f"SELECT {KEY}, frosic2007, classification, l_value FROM o_valued",
    "imputation_class": """
SELECT reference, period, cell_no, CAST(cell_no // 10 AS DOUBLE) AS imputation_class
FROM sv_units""",
    "flag_total_only": flag_query("total_only", '"290_flag"'),
    "flag_total_zero": flag_query("total_zero", "is_total_only_and_zero"),
    "expected_questions": expected(True),
    "skipped_questions": f"""
SELECT e.*, u.status, u.statusencoded, FALSE AS skipped_question FROM o_plain_expected e
JOIN sv_units u USING (reference, period)
UNION ALL BY NAME
SELECT u.reference, u.period, q AS questioncode, FALSE AS "290_flag", 0 AS adjustedresponse,
       u.status, u.statusencoded, TRUE AS skipped_question
FROM sv_units u, (SELECT UNNEST([{COMPONENTS}]) AS q)
WHERE u.status IN ({CLEAR}, {NIL})
  AND EXISTS (SELECT 1 FROM o_plain_expected f
              WHERE f.reference = u.reference AND f.period = u.period)
  AND NOT EXISTS (SELECT 1 FROM o_plain_expected f WHERE f.reference = u.reference
                  AND f.period = u.period AND f.questioncode = q)""",
    "stage_panel": f"""
SELECT {KEY}, "290_flag", is_total_only_and_zero, status, cell_no, adjustedresponse,
       imputation_flags_adjustedresponse, response, skipped_question, live_adjustedresponse,
       converted_frotover, imputation_class, q290_component_set_null FROM o_staged""",
    # imputation
    "match_flags": f"""
SELECT {KEY}, f_match_adjustedresponse, b_match_adjustedresponse, flag_construction_matches
FROM o_matched""",
    "match_counts": """
SELECT questioncode, imputation_class, period, f_match_adjustedresponse_count,
       b_match_adjustedresponse_count, flag_construction_matches_count FROM o_links""",
    "links": f"""
SELECT questioncode, imputation_class, period, f_link_adjustedresponse,
       b_link_adjustedresponse, default_link_f_match_adjustedresponse,
       default_link_b_match_adjustedresponse FROM o_links""",
    "links_filtered": f"""
SELECT * RENAME (f_match_adjustedresponse_count AS f_match_filtered_adjustedresponse_count,
                 b_match_adjustedresponse_count AS b_match_filtered_adjustedresponse_count)
FROM o_filtered_links""",
    "construction_link": f"""
SELECT questioncode, imputation_class, period, construction_link,
       default_link_flag_construction_matches FROM o_links""",
    "mark_backdata": f"""
SELECT {KEY}, period = {BACK} AS is_backdata, imputation_flags_adjustedresponse
FROM sv_answers""",
    "manual_construction":
        f"SELECT {KEY}, adjustedresponse, adjustedresponse_man FROM o_chain",
    "forward_impute":
        f"SELECT {KEY}, forward_value, forward_kind FROM o_values",
    "backward_impute": f"SELECT {KEY}, backward_value FROM o_values",
    "construct":
        f"SELECT {KEY}, constructed_value, constructed_kind FROM o_values",
    "ratio_of_means": f"""
SELECT {KEY}, adjustedresponse, imputation_flags_adjustedresponse, is_backdata
FROM o_rom""",
    "rescale_total_only": f"""
SELECT {KEY}, adjustedresponse, adjustedresponse_pre_rescale,
       failed_rescale FROM o_rescaled""",
    "check_totals": f"""
SELECT t.period, t.reference, t.adjustedresponse AS adjustedresponse,
       s.parts AS components_sum, t.failed_rescale
FROM o_imputed t JOIN (SELECT reference, period, COALESCE({xsum('adjustedresponse')}, 0) AS parts
  FROM o_imputed WHERE questioncode <> 290 GROUP BY reference, period) s
USING (reference, period)
WHERE t.questioncode = 290 AND ABS(t.adjustedresponse - s.parts) >= 0.001""",
    "impute_panel": f"""
SELECT {KEY}, adjustedresponse, adjustedresponse_pounds_thousands,
       imputation_flags_adjustedresponse, derived_zeros, failed_rescale, converted_frotover
FROM o_imputed""",
    # estimation
    "is_sampled": """
SELECT p.*, s.reference IS NOT NULL AS is_sampled FROM sv_population p
LEFT JOIN sv_sample s USING (reference, period)""",
    "population_counts": "SELECT * FROM o_counts",
    "design_weight": f"SELECT period, cell_no, design_weight FROM o_cells",
    "calibration_factor":
        f"SELECT period, cell_no, is_census, calibration_factor FROM o_cells",
    "estimate": f"""
SELECT {KEY}, is_sampled, is_census, design_weight, calibration_factor
FROM o_weighted""",
    # outliers
    "winsorise": f"""
SELECT {KEY}, CASE WHEN questioncode <> 290 THEN nw_ag_flag END AS nw_ag_flag,
       CASE WHEN questioncode <> 290 THEN predicted_unit_value END
           AS predicted_unit_value,
       CASE WHEN questioncode <> 290 THEN new_target_variable END
           AS new_target_variable, outlier_weight FROM o_winsorised""",
    "census_cells": f"""
SELECT {KEY}, COALESCE(is_census, FALSE) OR listed AS is_census, nw_ag_flag OR listed AS nw_ag_flag,
       CASE WHEN listed THEN adjustedresponse ELSE new_target_variable END AS new_target_variable,
       CASE WHEN listed THEN 1 ELSE outlier_weight END AS outlier_weight
FROM (SELECT w.*, COALESCE(w.is_sampled AND p.own_cell IN (23, 71, 104), FALSE) AS listed
      FROM o_winsorised w
      LEFT JOIN (SELECT reference, period, cell_no AS own_cell FROM sv_population) p
      USING (reference, period))
WHERE questioncode <> 290""",
    "total_outlier_weight":
        f"SELECT {KEY}, outlier_weight FROM o_total_weights WHERE questioncode = 290",
    "manual_outlier_weight": f"""
SELECT {KEY}, COALESCE(h.outlier_weight, froempment / 100.0::DOUBLE) AS outlier_weight
FROM o_imputed LEFT JOIN sv_manual_weights h USING ({KEY})""",
    "winsorised_value": f"SELECT {KEY}, winsorised_value FROM o_trimmed",
    "detect_outlier": f"""
SELECT {KEY}, classification, outlier_weight, winsorised_value
FROM o_trimmed""",
    # outputs
    "results_table": f"""
SELECT * FROM o_results""",
    "routing": "SELECT * FROM o_routed",
    "drop_nil": """
SELECT q.* FROM sv_legacy_questions q JOIN sv_legacy_units u USING (reference, period)
WHERE u.response_type <> 5""",
    "qa_suffix": f"""
SELECT {KEY}, imputation_flags_adjustedresponse, "290_flag" FROM o_suffixed""",
    "qa_pivot": qa("(SELECT * FROM o_results WHERE questioncode <> 290)", c.COMPONENTS),
    "qa_output": qa(f"""(SELECT * FROM o_suffixed_fir WHERE questioncode <> 290
        AND questioncode NOT IN ({UNPROCESSED}))""", c.COMPONENTS),
    "constructed": f"""
SELECT reference, questioncode, adjustedresponse AS constructedresponse,
       imputation_flags_adjustedresponse AS imputationmarker FROM o_thousands_fir
WHERE period = 200111 AND imputation_flags_adjustedresponse IS DISTINCT FROM 'r'""",
    "imputation_contribution": f"""
SELECT COALESCE(questioncode, 290) AS questioncode, returned,
       returned + imputed AS total, imputed FROM o_contribution""",
    "growth_table": growth("o_bands", PERIODS),
    "cord": CORD,
    "sizeband": SIZEBAND,
    "standard_errors": """
SELECT period, questioncode, classification, cell_no,
       CAST(ROUND(CAST(v AS DECIMAL(38,9)), 3) AS DOUBLE) AS sample_var,
       CAST(ROUND(CAST(SQRT(v / n) AS DECIMAL(38,9)), 3) AS DOUBLE) AS std_error,
       CAST(ROUND(CAST(100 * SQRT(v) / NULLIF(mean, 0) AS DECIMAL(38,9)), 3) AS DOUBLE) AS cov
FROM (SELECT period, questioncode, classification, cell_no, n,
             CASE WHEN n > 1 THEN CAST(n * squares - total * total AS DOUBLE)
                                  / (CAST(n AS DOUBLE) * (n - 1) * 1e18) END AS v,
             CAST(total AS DOUBLE) / 1e9 / NULLIF(n, 0) AS mean
      FROM (SELECT period, questioncode, classification, cell_no, COUNT(x) AS n,
                   SUM(x * x) AS squares, SUM(x) AS total
            FROM (SELECT *, CAST(ROUND(CAST(adjustedresponse_pounds_thousands
                                            AS DECIMAL(28,9)) * 1000000000) AS HUGEINT) AS x
                  FROM o_trimmed)
            GROUP BY period, questioncode, classification, cell_no))""",
    "rm_regional_employment": "SELECT reference, period, " + ", ".join(
        f'CAST(SUM(employment) FILTER (WHERE region IN ({region_list(codes)})) AS BIGINT)'
        f' AS "employment_{name}"' for name, codes in c.REGIONS.items())
        + " FROM sv_local_units GROUP BY reference, period",
    "rm_total_employment": """
SELECT reference, period, CAST(SUM(employment) AS BIGINT) AS total_employment
FROM sv_local_units GROUP BY reference, period""",
    "rm_percent": "SELECT reference, period, " + ", ".join(
        f'"percentage_{name}" AS "percentage_{name}"' for name in c.REGIONS)
        + " FROM o_shares",
    "rm_fill_own_region": f"SELECT {KEY}, region, gross_turnover_uk, " + ", ".join(
        f'"percentage_{name}" AS "percentage_{name}"' for name in c.REGIONS)
        + " FROM o_filled",
    "rm_turnover": f"SELECT {KEY}, gross_turnover_uk, " + ", ".join(
        f'"percentage_{name}" * gross_turnover_uk AS "turnover_{name}"'
        for name in c.REGIONS) + " FROM o_filled",
    "rm_output": repair("quarter = '2001Q3'"),
    "rm_output_latest": repair("quarter = (SELECT MAX(quarter) FROM o_long_turnover)"),
    "quarterly_extract": f"""
SELECT quarter, region_name, {', '.join(
    f'{xsum(TARGET_GROSS, f"questioncode = {q}")} AS "{q}"'
    for q in c.REPAIR_QUESTIONS)}
FROM (SELECT t.*, {QUARTER} AS quarter, n.region_name FROM o_thousands t
      JOIN sv_regions n ON n.region_code = t.region
      WHERE questioncode IN (202, 212, 222, 232, 243))
WHERE quarter = '2001Q3' GROUP BY quarter, region_name""",
    "outputs_registry": f"""
SELECT 'imputes_and_constructed_output' AS output, COUNT(*) AS n_rows FROM o_thousands_fir
WHERE period = 200111 AND imputation_flags_adjustedresponse IS DISTINCT FROM 'r'
UNION ALL SELECT 'quarterly_by_sizeband_output', COUNT(*) FROM ({SIZEBAND})
UNION ALL SELECT 'produce_qa_output', COUNT(*) FROM (SELECT DISTINCT reference, period
  FROM o_results WHERE questioncode <> 290 AND questioncode NOT IN ({UNPROCESSED}))
UNION ALL SELECT 'imputation_contribution_output', COUNT(*) FROM o_contribution
UNION ALL SELECT 'cord_output', COUNT(*) FROM ({CORD})
UNION ALL SELECT 'r_m_output', COUNT(*) FROM ({repair(
    "quarter = (SELECT MAX(quarter) FROM o_long_turnover)")})""",
    # gates
    "gate_staging": f"""
SELECT CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) FILTER (WHERE n > 1) AS n_repeated_keys
FROM (SELECT COUNT(*) AS n FROM o_staged GROUP BY {KEY})""",
    "gate_imputation": """
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE adjustedresponse IS NULL) AS n_without_value,
       COUNT(*) FILTER (WHERE imputation_flags_adjustedresponse IS NULL) AS n_without_marker
FROM o_imputed""",
    "gate_estimation": """
SELECT COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE design_weight IS NULL OR calibration_factor IS NULL)
           AS n_without_weight,
       COUNT(*) FILTER (WHERE design_weight < 1) AS n_weight_below_one FROM o_weighted""",
    "gate_outliers": """
SELECT COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE outlier_weight <= 0 OR outlier_weight > 1)
           AS n_weight_out_of_range,
       COUNT(*) FILTER (WHERE outlier_weight IS NULL AND l_value IS NOT NULL
                        AND questioncode <> 290) AS n_weight_unexplained FROM o_trimmed""",
}

_BEFORE_D = """
SELECT DISTINCT reference, questioncode FROM (
  SELECT *, LAG(imputation_flags_adjustedresponse) OVER (
           PARTITION BY reference, questioncode ORDER BY period) AS before
  FROM o_imputed WHERE questioncode <> 290)
WHERE imputation_flags_adjustedresponse = 'd' AND COALESCE(before NOT IN ('r', 'd'), TRUE)"""
_SQL["check_r_before_d"] = _BEFORE_D
_SQL["check_r_before_d_top5"] = _BEFORE_D + " ORDER BY reference, questioncode LIMIT 5"

# A total added to the plain imputed panel, and derived there, without rescaling.
CTES["o_plain_total"] = f"""
SELECT {KEY}, status, imputation_flags_adjustedresponse, "290_flag", adjustedresponse
FROM o_zeroed
UNION ALL
SELECT u.reference, u.period, 290, u.status, 'd_create', FALSE, 0 FROM sv_units u
WHERE EXISTS (SELECT 1 FROM o_zeroed z WHERE z.reference = u.reference AND z.period = u.period)
  AND NOT EXISTS (SELECT 1 FROM o_zeroed z WHERE z.reference = u.reference
                  AND z.period = u.period AND z.questioncode = 290)"""
_SQL["create_total"] = f"""
SELECT {KEY}, status, imputation_flags_adjustedresponse, "290_flag",
       adjustedresponse FROM o_plain_total"""
_SQL["derive_total"] = f"""
SELECT {KEY},
       CASE WHEN questioncode = 290 AND imputation_flags_adjustedresponse <> 'r' THEN 'd'
            ELSE imputation_flags_adjustedresponse END AS imputation_flags_adjustedresponse,
       CASE WHEN questioncode = 290 AND imputation_flags_adjustedresponse <> 'r'
             THEN COALESCE(s.parts, adjustedresponse) ELSE adjustedresponse END
           AS adjustedresponse
FROM o_plain_total LEFT JOIN (
  SELECT reference, period, COALESCE({xsum('adjustedresponse')}, 0) AS parts FROM o_plain_total
  WHERE questioncode <> 290 AND imputation_flags_adjustedresponse IS DISTINCT FROM 'r'
    AND NOT "290_flag" GROUP BY reference, period) s USING (reference, period)"""

_SQL["sink_by_period"] = _SQL["qa_output"]

ORACLES = {name: statement(sql) for name, sql in _SQL.items()}

# The same results with the links of a filtered run.
ORACLES["results_table_filtered"] = statement("""
SELECT * RENAME (f_match_adjustedresponse_count AS f_match_filtered_adjustedresponse_count,
                 b_match_adjustedresponse_count AS b_match_filtered_adjustedresponse_count)
FROM o_results""", CTES | {"o_chain": CTES["o_chain"].replace("JOIN o_links l",
                                                             "JOIN o_filled_links l")})
