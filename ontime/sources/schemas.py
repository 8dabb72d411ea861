"""Explicit schemas for the flight, carrier and airport sources.

Types follow the documented meaning of each column; CSV files are read
with these types instead of an inference pass over the fact file.
"""

from __future__ import annotations

from pyspark.sql import types as T

_I, _D, _S, _DT = T.IntegerType(), T.DoubleType(), T.StringType(), T.DateType()

# Documented flight columns and their types.
FLIGHT_COLUMN_TYPES: dict[str, T.DataType] = {
    "Year": _I, "Month": _I, "DayofMonth": _I, "FlightDate": _DT,
    "Reporting_Airline": _S, "Tail_Number": _S, "Flight_Number_Reporting_Airline": _I,
    "Origin": _S, "OriginCityName": _S, "OriginWac": _I,
    "Dest": _S, "DestCityName": _S, "DestWac": _I,
    "CRSDepTime": _I, "WheelsOff": _I, "DepDelay": _D, "TaxiOut": _D,
    "WheelsOn": _I, "CRSArrTime": _I, "TaxiIn": _D, "ArrDelay": _D,
    "CRSElapsedTime": _D, "ActualElapsedTime": _D, "AirTime": _D, "Flights": _D, "Distance": _D,
    "CarrierDelay": _D, "WeatherDelay": _D, "NASDelay": _D, "SecurityDelay": _D,
    "LateAircraftDelay": _D,
    "FirstDepTime": _I, "TotalAddGTime": _D, "LongestAddGTime": _D,
    # 0/1 flags are published as "1.00": read as DOUBLE, compared with 1.
    "Cancelled": _D, "Diverted": _D, "CancellationCode": _S,
    "DivAirportLandings": _I, "DivReachedDest": _D,
    "DivActualElapsedTime": _D, "DivArrDelay": _D, "DivDistance": _D,
    "Div1Airport": _S, "Div1AirportID": _I, "Div1AirportSeqID": _I, "Div1WheelsOn": _I,
    "Div1TotalGTime": _D, "Div1LongestGTime": _D, "Div1WheelsOff": _I, "Div1TailNum": _S,
    "Div2Airport": _S, "Div2AirportID": _I, "Div2AirportSeqID": _I, "Div2WheelsOn": _I,
    "Div2TotalGTime": _D, "Div2LongestGTime": _D, "Div2WheelsOff": _I, "Div2TailNum": _S,
}

# The carrier and airport columns the reports read.
CARRIER_COLUMN_TYPES: dict[str, T.DataType] = {"carrier": _S, "name": _S}
AIRPORT_COLUMN_TYPES: dict[str, T.DataType] = {
    "iata_code": _S, "name": _S, "longitude_deg": _D, "latitude_deg": _D, "timezone": _S,
}

CAUSE_COLUMNS = ["CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]


def schema_for_header(header: list[str], known: dict[str, T.DataType]) -> T.StructType:
    """Build a schema in file order; unknown columns are read as strings."""
    return T.StructType([T.StructField(name, known.get(name, _S), True) for name in header])


FLIGHTS_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in FLIGHT_COLUMN_TYPES.items()])
CARRIERS_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in CARRIER_COLUMN_TYPES.items()])
AIRPORTS_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in AIRPORT_COLUMN_TYPES.items()])
