"""Spark SQL counterparts of some operators, over silver or bronze.

For users who work in SQL, and the other side of the cross-implementation
check (U2/C3): each statement reaches its operator's answer by another route
(histograms, two-level counts), so that a mistake in one shows as a difference.

Every statement takes its table as a DataFrame parameter (``{src}``), so no
view is registered in the session and parallel calls cannot collide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripledger.operators.profile import duplicate_keys


def monthly_report_sql(spark: SparkSession, silver: DataFrame) -> DataFrame:
    """A3 from silver, by the distinct amounts of each month."""
    return spark.sql("""
        WITH amounts AS (
          SELECT pickup_year_month AS competencia, total_amount AS v,
                 flag_valor_nao_positivo AS refund, count(*) AS n
          FROM {src} GROUP BY pickup_year_month, total_amount, flag_valor_nao_positivo)
        SELECT competencia, sum(n) AS corridas,
          round(sum(v * n) / nullif(sum(n) FILTER (WHERE v IS NOT NULL), 0), 2)
            AS ticket_medio_bruto,
          round(sum(v * n) FILTER (WHERE NOT refund) / nullif(sum(n) FILTER (WHERE NOT refund), 0), 2)
            AS ticket_medio_sem_nao_positivos,
          round(sum(v * n), 2) AS faturamento_bruto,
          round(sum(v * n) FILTER (WHERE NOT refund), 2) AS faturamento_sem_nao_positivos,
          coalesce(sum(n) FILTER (WHERE refund), 0) AS lancamentos_nao_positivos
        FROM amounts GROUP BY competencia""", src=silver)


def hourly_report_sql(spark: SparkSession, silver: DataFrame, period: str) -> DataFrame:
    """A4 of one month from silver, hours labelled ``03h``."""
    return spark.sql("""
        SELECT format_string('%02dh', pickup_hour) AS hora, count(*) AS corridas,
          round(avg(passenger_count), 4) AS media_passageiros,
          round(coalesce(sum(passenger_count), 0) / count(*), 4) AS media_nulo_como_zero,
          round(avg(nullif(greatest(passenger_count, 0), 0)), 4) AS media_apenas_positivos,
          count_if(passenger_count IS NULL) AS sem_registro
        FROM {src} WHERE pickup_year_month = :period GROUP BY pickup_hour""",
                     args={"period": period}, src=silver)


def duplicate_summary_sql(spark: SparkSession, bronze: DataFrame,
                          keys: list[str] | None = None) -> DataFrame:
    """A21 off the histogram of how often a key combination occurs."""
    cols = ", ".join(f"`{k}`" for k in keys or duplicate_keys())
    return spark.sql("""
        WITH often AS (
          SELECT times, count(*) AS combos
          FROM (SELECT %s, count(*) AS times FROM {src} GROUP BY ALL) GROUP BY 1)
        SELECT coalesce(sum(combos), 0) AS combinacoes_repetidas,
          sum(times * combos) AS registros_envolvidos,
          sum((times - 1) * combos) AS excedentes, max(times) AS maior_repeticao
        FROM often WHERE times > 1""" % cols, src=bronze)


def reload_detector_sql(spark: SparkSession, bronze: DataFrame) -> DataFrame:
    """A12 by the distinct (period, batch) pairs."""
    return spark.sql("""
        WITH batches AS (SELECT DISTINCT _ref_period, _ingested_at FROM {src})
        SELECT _ref_period, count(_ingested_at) AS lotes_distintos
        FROM batches GROUP BY _ref_period HAVING lotes_distintos >= 2""", src=bronze)


def month_sources_sql(spark: SparkSession, bronze: DataFrame) -> DataFrame:
    """A14 by (trip month, file period) cells."""
    return spark.sql("""
        WITH cells AS (
          SELECT date_trunc('MONTH', tpep_pickup_datetime) AS m, _ref_period, count(*) AS n
          FROM {src} GROUP BY m, _ref_period)
        SELECT date_format(m, 'yyyy-MM') AS mes_real, sum(n) AS registros,
          array_sort(array_agg(_ref_period)) AS arquivos_de_origem
        FROM cells GROUP BY m""", src=bronze)
