"""Texts written to the catalog beside tables and columns."""

TABLE_TEXTS = {
    "silver": "Typed trips of all services with repaired passenger counts and ordered timestamps, by pickup month.",
    "trips": "Trips as served for questions: one row per trip, by pickup month.",
    "metrics": "Additive sums per service, month and hour of day; means are a sum divided by a count.",
}

COLUMN_TEXTS = {
    "tipo": "service the trip was delivered by",
    "VendorID": "code of the provider that recorded the trip",
    "pickup_datetime": "start of the trip, wall-clock time without zone",
    "dropoff_datetime": "end of the trip, wall-clock time without zone",
    "pickup_datetime_tratado": "earlier of the two recorded times",
    "dropoff_datetime_tratado": "later of the two recorded times",
    "passenger_count": "passengers; the batch's median where none was recorded",
    "trip_distance": "distance driven, in miles",
    "fare_amount": "metered part of the amount",
    "tip_amount": "tip paid by card",
    "total_amount": "amount charged, all components together",
    "data_corrida": "day the trip began",
    "hora_do_dia": "hour of day the trip began, 0 to 23",
    "qtd_corridas": "number of trips",
    "soma_total_amount": "sum of the amounts charged",
    "soma_passenger_count": "sum of the passengers",
    "year": "year the trip began",
    "month": "month the trip began",
}
