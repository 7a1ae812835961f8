"""Per-service adapters: bring each source layout to the common trip names.

A service is described declaratively (renames, casts, constants, tag) and
``standardize`` turns the spec into a single ``select``, so Catalyst sees one
Project over the scan and prunes columns the later steps never use.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from lakeops.functions.schema import quote, resolve_column, sql_literal, try_cast_sql


@dataclass(frozen=True)
class ServiceSpec:
    name: str
    renames: dict = field(default_factory=dict)
    casts: dict = field(default_factory=dict)
    constants: dict = field(default_factory=dict)   # name -> (value, type)


# Service A (yellow) source layout.
SERVICE_A = ServiceSpec(
    name="yellow",
    renames={"tpep_pickup_datetime": "pickup_datetime",
             "tpep_dropoff_datetime": "dropoff_datetime"},
    casts={"VendorID": "int", "passenger_count": "long", "RatecodeID": "long",
           "payment_type": "long", "airport_fee": "double"},
    constants={"ehail_fee": (0.0, "double"), "trip_type": (0, "long")},
)

# Service B (green) source layout.
SERVICE_B = ServiceSpec(
    name="green",
    renames={"lpep_pickup_datetime": "pickup_datetime",
             "lpep_dropoff_datetime": "dropoff_datetime"},
    casts={"VendorID": "int", "passenger_count": "long", "RatecodeID": "long",
           "payment_type": "long", "trip_type": "long"},
    constants={"airport_fee": (0.0, "double")},
)

SERVICES = {SERVICE_A.name: SERVICE_A, SERVICE_B.name: SERVICE_B}
SERVICE_TAG_COLUMN = "tipo"


def standardize_sql(df: DataFrame, spec: ServiceSpec, tag_column: str = SERVICE_TAG_COLUMN, cast: bool = True) -> list[str]:
    """The select list of ``standardize``, as SQL text."""
    wanted = list(spec.renames) + list(spec.casts)
    actual_to_spec = {}
    for name in wanted:
        actual = resolve_column(df, name)
        if actual is not None:
            actual_to_spec[actual] = name
    exprs = []
    for c in df.columns:
        canonical = actual_to_spec.get(c, c)
        out_name = spec.renames.get(canonical, canonical)
        if out_name in spec.constants or out_name == tag_column:
            continue
        if cast and canonical in spec.casts:
            expr = try_cast_sql(df, c, spec.casts[canonical])
        else:
            expr = quote(c)
        exprs.append(f"{expr} AS {quote(out_name)}")
    for name, (value, dtype) in spec.constants.items():
        exprs.append(f"CAST({sql_literal(value)} AS {dtype}) AS {quote(name)}")
    exprs.append(f"{sql_literal(spec.name)} AS {quote(tag_column)}")
    return exprs


def standardize(df: DataFrame, spec: ServiceSpec, tag_column: str = SERVICE_TAG_COLUMN,
                cast: bool = True) -> DataFrame:
    """Rename, cast and tag one service's rows in a single projection.

    Column names named by the spec are matched ignoring case (a source may
    spell ``airport_fee`` as ``Airport_fee``). Casts are ``try_cast``: a value
    that does not fit becomes NULL instead of failing the job. Columns the spec
    does not mention pass through unchanged. ``cast=False`` keeps the raw
    types (input of the cast-loss audit, so losses of these casts show too).
    """
    # one selectExpr: a single call to the JVM whatever the number of columns
    return df.selectExpr(*standardize_sql(df, spec, tag_column, cast))
