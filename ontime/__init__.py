"""ontime: flight on-time analytics as PySpark DataFrame plans.

Every public function takes and returns Spark DataFrames (or fitted
``pyspark.ml`` models); nothing collects fact-sized data to the driver.

    from ontime import FlightReports, load_flight_sources, session_builder
    spark = session_builder().getOrCreate()
    flights, carriers, airports = load_flight_sources(spark, "flights.csv", "airlines.csv", "airports.csv")
    FlightReports(spark, flights, carriers, airports).busiest_airports(k=25).show()
"""

from ontime.plans.dashboard import FlightReports  # noqa: F401
from ontime.session import session_builder  # noqa: F401
from ontime.sources import load_flight_sources  # noqa: F401

__version__ = "0.1.0"
