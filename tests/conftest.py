import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fareloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", shuffle_partitions=4,
        # compiling plans costs more than running them on a few rows; tools/check_oracles.py runs them compiled
        **{"spark.sql.codegen.wholeStage": "false", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RAW = (
    "airline string, source_code string, source_name string, destination_code string, destination_name string,"
    " departure_datetime timestamp_ntz, arrival_datetime timestamp_ntz, duration_hrs double, stopovers string,"
    " aircraft_type string, travel_class string, booking_source string, base_fare_bdt double,"
    " tax_surcharge_bdt double, total_fare_bdt double, seasonality string, days_before_departure int"
)
NAMES = [part.split()[0] for part in RAW.split(",")]
GOOD = dict(
    airline="us-bangla AIRLINES", source_code="DAC", source_name="hazrat shahjalal", destination_code="CXB",
    destination_name="cox's bazar", duration_hrs=1.5, stopovers="Direct", aircraft_type="Boeing 737",
    travel_class="Economy", booking_source="Direct Booking", base_fare_bdt=1000.0, tax_surcharge_bdt=100.0,
    total_fare_bdt=1100.0, seasonality="Regular", days_before_departure=10,
)


@pytest.fixture(scope="session")
def make(spark):
    """Bookings from partial rows: what is not given is that of a good row."""
    import datetime as dt

    def build(*rows):
        when = dt.datetime(2025, 3, 4, 10, 0)
        data = []
        for i, given in enumerate(rows):
            row = dict(GOOD, departure_datetime=when, arrival_datetime=when + dt.timedelta(hours=2))
            row.update({k: v for k, v in given.items() if k != "id"})
            data.append((given.get("id", str(i)), *[row[n] for n in NAMES]))
        return spark.createDataFrame(data, f"id string, {RAW}")

    return build
