"""Channel keys and CF names of instrument channels."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Instrument name, long_name, standard_name.
KNOWN = [
    ("temperature", "Sea water temperature", "sea_water_temperature"),
    ("temperature_corrected", "Sea water temperature (thermal-lag corrected)", "sea_water_temperature"),
    ("conductivity", "Sea water electrical conductivity", "sea_water_electrical_conductivity"),
    ("pressure", "Absolute pressure", "sea_water_pressure"),
    ("sea_pressure", "Sea pressure", "sea_water_pressure_due_to_sea_water"),
    ("pressure_drift", "Pressure sensor drift correction", None),
    ("bpr_pressure", "Bottom pressure recorder pressure", "sea_water_pressure_at_sea_floor"),
    ("bpr_corrected_pressure", "Bottom pressure recorder pressure (drift corrected)", "sea_water_pressure_at_sea_floor"),
    ("barometer_pressure", "Barometer atmospheric pressure", "air_pressure"),
    ("bpr_temperature", "Bottom pressure recorder internal temperature", None),
    ("barometer_temperature", "Barometer internal temperature", None),
    ("atmospheric_pressure", "Atmospheric pressure (for sea pressure correction)", "air_pressure"),
    ("salinity", "Practical salinity", "sea_water_practical_salinity"),
    ("depth", "Depth", "depth"),
    ("velocity", "Profiling velocity", None),
    ("specific_conductivity", "Specific conductivity (referenced to 25°C)", None),
    ("dissolved_o2_concentration", "Dissolved oxygen concentration", "mole_concentration_of_dissolved_molecular_oxygen_in_sea_water"),
    ("dissolved_o2_saturation", "Dissolved oxygen saturation", "fractional_saturation_of_oxygen_in_sea_water"),
    ("dissolved_o2_concentration_corrected", "Dissolved oxygen concentration (corrected)", "mole_concentration_of_dissolved_molecular_oxygen_in_sea_water"),
    ("dissolved_o2_saturation_corrected", "Dissolved oxygen saturation (corrected)", "fractional_saturation_of_oxygen_in_sea_water"),
    ("buoyancy_frequency_squared", "Buoyancy frequency squared", "square_of_brunt_vaisala_frequency_in_sea_water"),
    ("stability", "Water column stability", None),
    ("density_anomaly", "Density anomaly", "sea_water_sigma_theta"),
    ("absolute_salinity", "Absolute salinity", "sea_water_absolute_salinity"),
    ("potential_temperature", "Potential temperature", "sea_water_potential_temperature"),
    ("speed_of_sound", "Speed of sound in sea water", "speed_of_sound_in_sea_water"),
    ("chlorophyll", "Chlorophyll fluorescence (raw counts)", None),
    ("backscatter", "Optical backscatter (raw counts)", None),
    ("phycoerythrin", "Phycoerythrin fluorescence (raw counts)", None),
    ("x_axis_acceleration", "X-axis acceleration", None),
    ("y_axis_acceleration", "Y-axis acceleration", None),
    ("z_axis_acceleration", "Z-axis acceleration", None),
    ("accelerometer_temperature", "Accelerometer internal temperature", None),
]


@dataclass(frozen=True)
class Names:
    long_name: str
    standard_name: str | None


_BY_NAME = {name: Names(long_name, standard) for name, long_name, standard in KNOWN}


def names(instrument_name: str) -> Names:
    """CF names of a channel; an unknown one is called what the instrument calls it."""
    return _BY_NAME.get(instrument_name, Names(instrument_name, None))


def slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", text.lower()).strip("_")


def channel_key(instrument_name: str) -> str:
    """The long name's slug without `sea_water` and an `in` before it, unless nothing else is in it."""
    full = slug(names(instrument_name).long_name)
    short = re.sub(r"(?:_in)?_sea_water(?=_)", "", f"_{full}_").strip("_")
    short = re.sub(r"^in_(?=sea_water)", "", short)
    return short or full


def channel_keys(instrument_names: list[str]) -> dict[str, str]:
    """Instrument name to key; where two would have one key the later keeps its instrument name."""
    out: dict[str, str] = {}
    for n in instrument_names:
        key = channel_key(n)
        out[n] = n if key in out.values() else key
    return out


def slug_column(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")
