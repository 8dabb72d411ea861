from ontime.sources.readers import (  # noqa: F401
    cache_fact,
    load_flight_sources,
    load_tables,
    read_airports_csv,
    read_carriers_csv,
    read_flights_csv,
    read_table,
    register_views,
)
