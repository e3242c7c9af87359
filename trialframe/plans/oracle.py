"""ANSI SQL (DuckDB dialect) equivalents of the registered queries.

Each string runs on the driver's pre-registered views.  ``TRIALS`` is the
S11 projection as a CTE body.  Decimal literals are written as ``0.30e0`` so
both engines treat them as DOUBLE.
"""

TRIALS = """
  SELECT
    concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key,
    100e0 + l_extendedprice / 175e0 AS mol_weight,
    l_tax * 100e0 - 2e0 AS logp,
    20e0 + 180e0 * (o_totalprice / 500000e0) AS tpsa,
    CAST(l_linenumber % 7 AS DOUBLE) AS hbd,
    CAST(p_size % 13 AS DOUBLE) AS hba,
    CAST(p_size % 15 AS DOUBLE) AS rotatable_bonds,
    CAST(l_partkey % 5 AS DOUBLE) AS aromatic_rings,
    CAST(18 + l_suppkey % 62 AS DOUBLE) AS patient_age,
    40e0 + 110e0 * ((c_acctbal + 1000e0) / 11000e0) AS patient_weight_kg,
    15e0 + 2.7e0 * l_quantity AS creatinine_clearance,
    CAST(o_custkey % 2 AS DOUBLE) AS is_male,
    800e0 * l_discount AS baseline_crp,
    200e0 * (1e0 - o_totalprice / 500000e0) AS baseline_il6,
    3e0 * (p_retailprice - 900e0) AS baseline_tnfa,
    2e0 + 18e0 * (l_quantity / 50e0) AS baseline_wbc,
    CASE l_partkey % 5 WHEN 0 THEN 25e0 WHEN 1 THEN 50e0 WHEN 2 THEN 100e0
                       WHEN 3 THEN 200e0 ELSE 400e0 END AS dose_mg,
    CAST(7 + l_orderkey % 83 AS DOUBLE) AS treatment_days,
    CAST((l_partkey * 7919) % 1000 AS DOUBLE) / 1000e0 AS noise,
    'SAMPLE_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS sample_id,
    'BATCH_' || l_returnflag AS batch_id,
    l_shipdate AS ingestion_timestamp,
    CASE WHEN l_linestatus = 'F' THEN 'reference' ELSE 'production' END AS side
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
"""

TRIALS_LABELLED = f"""
  SELECT t.*,
    CAST((0.30e0 * CAST((mol_weight <= 500 AND logp <= 5 AND hbd <= 5 AND hba <= 10) AS DOUBLE)
          + 0.15e0 * (dose_mg / 400e0)
          + 0.10e0 * (treatment_days / 90e0)
          + 0.10e0 * (1e0 - baseline_crp / 80e0)
          + 0.10e0 * (creatinine_clearance / 150e0)
          + 0.25e0 * noise) > 0.45e0 AS INTEGER) AS efficacy_label
  FROM ({TRIALS}) t
"""


def with_trials(body: str, extra_ctes: str = "") -> str:
    """Prefix a query with the ``trials`` CTE (and optional more CTEs)."""
    more = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH trials AS ({TRIALS_LABELLED}){more}\n{body}"
