"""Column names, scope and thresholds of the trip model.

Everything a query needs to know about the layout of a trip table lives in
``TripSpec``; the analysed time window lives in ``Scope``.  Both are frozen so
they can be passed around freely and used as defaults.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values.  These must stay exactly as written for results to match the
# original pipeline: reason labels, flag/metric column names, the vendor
# dictionary, the passenger and duration thresholds, and the canonical source
# schema (name -> Spark type, in source order).
# ---------------------------------------------------------------------------

REASON_OUT_OF_SCOPE = "fora_do_escopo_temporal"
REASON_BAD_DURATION = "duracao_nao_positiva"

EXPECTED_VENDORS = (1, 2)
MAX_PLAUSIBLE_PASSENGERS = 6
EXTREME_DURATION_SECONDS = 24 * 60 * 60

CANONICAL_TYPES: dict[str, str] = {
    "VendorID": "int",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "int",
    "trip_distance": "double",
    "RatecodeID": "int",
    "store_and_fwd_flag": "string",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

REQUIRED_COLUMNS = (
    "VendorID",
    "passenger_count",
    "total_amount",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
)

# Silver flag columns, in table order.
FLAG_COLUMNS = (
    "flag_valor_nao_positivo",
    "flag_duracao_extrema",
    "flag_passageiros_ausente",
    "flag_passageiros_zero",
    "flag_passageiros_implausivel",
    "flag_vendor_fora_dicionario",
)

# Derived silver columns, in table order.
DERIVED_COLUMNS = (
    "trip_duration_seconds",
    "pickup_year_month",
    "pickup_date",
    "pickup_hour",
    "pickup_day_of_week",
)

REASON_COLUMN = "motivo_descarte"
SILVER_PARTITION = "pickup_year_month"
BRONZE_PARTITION = "_ref_period"
AUDIT_COLUMNS = ("_source_file", "_ingested_at", "_ref_period", "_ref_year", "_ref_month")

# Accuracy handed to ``percentile_approx`` (Spark's default): relative rank
# error 1e-4 with a sketch of bounded size per partial aggregate.  Reports
# that need exact quantiles use ``operators.quantiles.exact_quantiles``.
PERCENTILE_ACCURACY = 10_000


@dataclass(frozen=True)
class TripSpec:
    """Names of the columns a trip table must provide."""

    vendor: str = "VendorID"
    pickup: str = "tpep_pickup_datetime"
    dropoff: str = "tpep_dropoff_datetime"
    passengers: str = "passenger_count"
    amount: str = "total_amount"
    ref_period: str = "_ref_period"
    pickup_location: str = "PULocationID"
    dropoff_location: str = "DOLocationID"


@dataclass(frozen=True)
class Scope:
    """Inclusive range of ``yyyy-MM`` periods that the analysis covers."""

    first: str = "2023-01"
    last: str = "2023-05"

    def __post_init__(self) -> None:
        for p in (self.first, self.last):
            if len(p) != 7 or p[4] != "-" or not (p[:4] + p[5:]).isdigit():
                raise ValueError(f"period must be yyyy-MM, got {p!r}")
        if self.first > self.last:
            raise ValueError(f"empty scope {self.first}..{self.last}")

    def periods(self) -> list[str]:
        """Every month of the scope, in order."""
        y, m = int(self.first[:4]), int(self.first[5:])
        out = []
        while True:
            p = f"{y:04d}-{m:02d}"
            out.append(p)
            if p == self.last:
                return out
            m += 1
            if m == 13:
                y, m = y + 1, 1

    def start_literal(self) -> str:
        """First instant of the scope, as a ``timestamp_ntz`` literal."""
        return f"{self.first}-01 00:00:00"

    def end_literal(self) -> str:
        """First instant after the scope (half-open upper bound)."""
        y, m = int(self.last[:4]), int(self.last[5:]) + 1
        if m == 13:
            y, m = y + 1, 1
        return f"{y:04d}-{m:02d}-01 00:00:00"


@dataclass(frozen=True)
class Thresholds:
    """Quality thresholds; defaults are the fixed values above."""

    extreme_duration_seconds: int = EXTREME_DURATION_SECONDS
    max_passengers: int = MAX_PLAUSIBLE_PASSENGERS
    vendors: tuple[int, ...] = field(default=EXPECTED_VENDORS)


DEFAULT_SPEC = TripSpec()
DEFAULT_THRESHOLDS = Thresholds()
