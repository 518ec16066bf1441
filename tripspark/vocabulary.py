"""Names and texts that answers must contain exactly as they are here."""

# name in requests and answers -> name in stored bookings; the order is the order of an answer's list
PROVIDERS: dict[str, str] = {
    "drive-now": "drivenow",
    "deutsche-bahn": "deutschebahn",
}

BOOKED_TEXT = "booking success"
MISSING_TEXT = "route now found"
INVALID_TEXT = "invalid_request"

BOOKING_LINK_PREFIX = "/accounting-core-service/"
MOBILITY_SUFFIX = "mobility-service"
CITY_ERROR_BODY = '{"error" : "City not found in database"}'

SPAN_MEASUREMENT = "zipkin_spans"
ANNOTATION_MEASUREMENT = "zipkin_annotations"

EVENT_TYPE = -1  # a_type of a timed event; every other a_type is a tag
TEXT_TYPE = 6  # a_type of a text tag
