"""Typed schemas of the snapshot, gold and control tables (``CREATE TABLE IF
NOT EXISTS`` is ``sources.tables.create_if_missing`` with these)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, B, TS, DT = (T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(),
                         T.BooleanType(), T.TimestampType(), T.DateType())


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SILVER = _st(
    ("productid", S), ("sku", S), ("productname", S), ("brand", S), ("brandid", S),
    ("categoryid", S), ("categoria_principal", S), ("subcategoria", S), ("grupo_producto", S),
    ("canal_venta", S), ("tipo_especifico_producto", S),
    ("precio_regular", D), ("precio_online", D), ("precio_tarjeta_sip", D), ("full_price", D),
    ("descuento_base_pct", L), ("descuento_tarjeta_sip_pct", L),
    ("en_promocion", B), ("precio_promo_exacto", B), ("precio_valido", B),
    ("disponible", B), ("cantidad_disponible", I), ("unit_multiplier", D),
    ("vendedor", S), ("retira_hoy", B), ("llega_manana", B), ("envio_domicilio", B),
    ("recojo_tienda", B), ("alto_sodio", B), ("alto_azucar", B), ("alto_saturadas", B),
    ("num_octogonos", I), ("fecha_lanzamiento", DT), ("secciones_origen", T.ArrayType(S)),
    ("ingesta_date", DT), ("batch_id", S), ("created_timestamp", TS), ("updated_timestamp", TS))

DIM_FECHA = _st(("fecha_key", L), ("fecha", DT), ("dia", I), ("mes", I), ("nombre_mes", S),
                ("trimestre", I), ("anio", I), ("dia_semana", S), ("es_fin_de_semana", B))
DIM_MARCA = _st(("marca_key", L), ("brandid", S), ("brand", S))
DIM_CANAL = _st(("canal_key", L), ("canal_venta", S))
DIM_CATEGORIA = _st(("categoria_key", L), ("categoryid", S), ("subcategoria", S),
                    ("grupo_producto", S), ("categoria_principal", S))
DIM_ETIQUETADO = _st(("etiquetado_key", L), ("alto_sodio", B), ("alto_azucar", B),
                     ("alto_saturadas", B), ("num_octogonos", I))
DIM_PRODUCTO = _st(("producto_key", L), ("productid", S), ("sku", S), ("productname", S),
                   ("tipo_especifico_producto", S), ("fecha_lanzamiento", DT), ("vendedor", S))

FACT = _st(("fecha_key", L), ("producto_key", L), ("marca_key", L), ("canal_key", L),
           ("categoria_key", L), ("etiquetado_key", L),
           ("precio_regular", D), ("precio_online", D), ("precio_tarjeta_sip", D),
           ("full_price", D), ("descuento_base_pct", L), ("descuento_tarjeta_sip_pct", L),
           ("cantidad_disponible", I), ("unit_multiplier", D), ("en_promocion", B),
           ("precio_promo_exacto", B), ("precio_valido", B), ("disponible", B),
           ("retira_hoy", B), ("llega_manana", B), ("envio_domicilio", B), ("recojo_tienda", B),
           ("ingesta_date", DT))

AUDIT = _st(("productid", S), ("productname", S), ("categoryid", S), ("subcategoria", S),
            ("grupo_producto", S), ("canal_venta", S), ("brandid", S),
            ("motivos", T.ArrayType(S)), ("ingesta_date", DT))

CONTROL = _st(("status", S), ("created_timestamp", TS), ("updated_timestamp", TS),
              ("start_time", TS), ("end_time", TS), ("error_message", S), ("batch_id", S))

DIMENSION_SCHEMAS = {"fecha": DIM_FECHA, "marca": DIM_MARCA, "canal": DIM_CANAL,
                     "categoria": DIM_CATEGORIA, "producto": DIM_PRODUCTO,
                     "etiquetado": DIM_ETIQUETADO}
