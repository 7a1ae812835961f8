"""Label texts that appear in report values (kept identical for users
switching from the original reports)."""

# Timestamp problem labels.
PICKUP_NULL = "pickup_nulo"
DROPOFF_NULL = "dropoff_nulo"
DROPOFF_BEFORE_PICKUP = "dropoff_menor_que_pickup"
VALID = "valido"

# Duration bands (upper bounds in minutes, exclusive) and labels.
DURATION_BANDS = [
    (10, "<10 min"),
    (20, "10-20 min"),
    (30, "20-30 min"),
    (60, "30-60 min"),
]
DURATION_BAND_LAST = ">60 min"

# Recomposition result labels and tolerance.
RECOMPOSE_OK = "Sem diferença"
RECOMPOSE_DIFF = "Com diferença"
RECOMPOSE_TOLERANCE = 0.01
