"""Shared SQL fragments for the DuckDB oracle texts.

Each fragment restates a binding of ``shelfwise.plans.bindings`` in plain SQL,
independently of the Spark code, so that the oracle checks the library rather
than repeating it.
"""

OBS_CTE = """
obs AS (
  SELECT user_id AS productid,
         'producto-' || CAST(user_id AS VARCHAR) AS productname,
         CAST(ts AS DATE) AS ingesta_date,
         strftime(ts, '%Y-%m-%d') AS batch_id,
         event_type AS categoria_principal,
         value AS precio_regular,
         json_extract_string(props, '$.k') AS seccion,
         value > 0 AS precio_valido,
         value > 50 AS en_promocion,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 <> 0 AS disponible,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 50 AS BIGINT)
           AS descuento_tarjeta_sip_pct,
         event_id
  FROM events)"""

SNAP_CTE = OBS_CTE + """,
obs_ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY productid, ingesta_date
                               ORDER BY precio_regular DESC, event_id) AS rn
  FROM obs),
obs_sections AS (
  SELECT productid, ingesta_date,
         list_sort(list(DISTINCT seccion) FILTER (WHERE seccion IS NOT NULL)) AS secciones_origen
  FROM obs GROUP BY productid, ingesta_date),
snap AS (
  SELECT r.productid, r.productname, r.ingesta_date, r.batch_id, r.categoria_principal,
         r.precio_regular, r.seccion, r.precio_valido, r.en_promocion, r.disponible,
         r.descuento_tarjeta_sip_pct, r.event_id, s.secciones_origen
  FROM obs_ranked r JOIN obs_sections s
    ON r.productid = s.productid AND r.ingesta_date = s.ingesta_date
  WHERE r.rn = 1)"""

SNAP_COLS = ("productid, productname, ingesta_date, batch_id, categoria_principal, precio_regular, "
             "seccion, precio_valido, en_promocion, disponible, descuento_tarjeta_sip_pct, event_id")


def money(x: str, scale: int = 2) -> str:
    """Portable half-up rounding of a money value (same form as ``money_round``)."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), {scale}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) * 100.0 / CAST({whole} AS DOUBLE), 1)"
