from ontime.streaming.traffic import (  # noqa: F401
    read_flight_stream,
    start_traffic_stream,
    streaming_traffic_windows,
)
