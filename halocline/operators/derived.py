"""Derived seawater variables, each despiked before the next ones use it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import seawater as sw
from .despike import Despiking, despike
from .model import KEYS, Keys, require
from .tables import Tally


@dataclass(frozen=True)
class Variable:
    key: str
    flag: str
    default: bool
    units: str
    long_name: str
    standard_name: str | None


#: The outputs in their order, with metadata.
VARIABLES = [
    Variable("z", "z", True, "m", "Height", "height"),
    Variable("practical_salinity", "practical_salinity", True, "1e-3", "Practical salinity", "sea_water_practical_salinity"),
    Variable("absolute_salinity", "absolute_salinity", True, "g kg-1", "Absolute salinity", "sea_water_absolute_salinity"),
    Variable("conservative_temperature", "conservative_temperature", True, "degree_C", "Conservative temperature", "sea_water_conservative_temperature"),
    Variable("density_anomaly", "potential_density", True, "kg m-3", "Potential density anomaly (sigma0)", "sea_water_sigma_theta"),
    Variable("potential_temperature", "potential_temperature", False, "degree_C", "Potential temperature", "sea_water_potential_temperature"),
    Variable("speed_of_sound", "sound_speed", False, "m s-1", "Speed of sound in sea water", "speed_of_sound_in_sea_water"),
    Variable("sea_water_density", "density", False, "kg m-3", "In-situ density", "sea_water_density"),
    Variable("spiciness", "spiciness", False, "kg m-3", "Spiciness (referenced to 0 dbar)", None),
    Variable("freezing_point", "freezing_point", False, "degree_C", "Freezing point (conservative temperature)", None),
    Variable("thermal_expansion_coefficient", "thermal_expansion", False, "K-1", "Thermal expansion coefficient", None),
    Variable("haline_contraction_coefficient", "haline_contraction", False, "kg g-1", "Haline contraction coefficient", None),
    Variable("oxygen_concentration_from_saturation", "oxygen_concentration", False, "umol kg-1", "Dissolved oxygen concentration (derived from saturation)", "mole_concentration_of_dissolved_molecular_oxygen_in_sea_water"),
]
ALWAYS = ("practical_salinity", "absolute_salinity", "conservative_temperature")


def derive(
    df: DataFrame,
    flags: Mapping[str, bool] | None = None,
    despiking: Mapping[str, Despiking] | None = None,
    keys: Keys = KEYS,
    conductivity: str = "electrical_conductivity",
    delta: Column | float = 0.0,
    oxygen: str = "dissolved_oxygen_saturation",
    cut: Callable[[DataFrame], DataFrame] = lambda df: df,
    tally: Tally | None = None,
) -> tuple[DataFrame, dict[str, DataFrame], list[str]]:
    """(df with the variables, thresholds by variable, names added). flags by Variable.flag; despiking by key.

    Needs conductivity, temperature, sea_pressure and latitude. Salinities and Conservative Temperature are computed in
    any case, as the others use them, and dropped again if their flag is off. Medians stay within a profile; thresholds
    are pooled over the deployment. cut is called after each despiked variable, to store it where the caller can: else
    each later variable's plan holds all earlier windows. delta: the anomaly of Absolute Salinity, 0 for reference
    composition.
    """
    on = {v.key: (flags or {}).get(v.flag, v.default) for v in VARIABLES}
    require(df, ["temperature", "sea_pressure", conductivity], "Cannot compute derived variables")
    if on["z"]:
        require(df, ["latitude"], "Cannot compute z")
    if on["oxygen_concentration_from_saturation"]:
        require(df, [oxygen], "Cannot compute oxygen concentration")
    sa, ct, p = F.col("absolute_salinity"), F.col("conservative_temperature"), F.col("sea_pressure")
    steps: dict[str, Callable[[DataFrame], DataFrame]] = {
        "z": lambda d: d.withColumn("z", sw.z_from_p(p, F.col("latitude"))),
        "practical_salinity": lambda d: sw.with_sp_from_c(d, "practical_salinity", conductivity, "temperature", "sea_pressure"),
        "absolute_salinity": lambda d: d.withColumn("absolute_salinity", sw.sa_from_sp(F.col("practical_salinity"), delta)),
        "conservative_temperature": lambda d: sw.with_ct_from_t(d, "conservative_temperature", "absolute_salinity", "temperature", "sea_pressure"),
        "density_anomaly": lambda d: d.withColumn("density_anomaly", sw.sigma0(sa, ct)),
        "potential_temperature": lambda d: sw.with_pt0_from_t(d, "potential_temperature", "absolute_salinity", "temperature", "sea_pressure"),
        "speed_of_sound": lambda d: d.withColumn("speed_of_sound", sw.sound_speed(sa, ct, p)),
        "sea_water_density": lambda d: d.withColumn("sea_water_density", sw.rho(sa, ct, p)),
        "spiciness": lambda d: d.withColumn("spiciness", sw.spiciness0(sa, ct)),
        "freezing_point": lambda d: d.withColumn("freezing_point", sw.ct_freezing(sa, p)),
        "thermal_expansion_coefficient": lambda d: d.withColumn("thermal_expansion_coefficient", sw.alpha(sa, ct, p)),
        "haline_contraction_coefficient": lambda d: d.withColumn("haline_contraction_coefficient", sw.beta(sa, ct, p)),
        "oxygen_concentration_from_saturation": lambda d: sw.with_o2sol(d, "_o2", "absolute_salinity", "conservative_temperature", delta).withColumn("oxygen_concentration_from_saturation", F.col("_o2") * F.col(oxygen) / 100.0).drop("_o2"),
    }
    order = [*ALWAYS, *(v.key for v in VARIABLES if v.key not in ALWAYS)]
    found: dict[str, DataFrame] = {}
    for key in order:
        if not on[key] and key not in ALWAYS:
            continue
        df = steps[key](df)
        if despiking and key in despiking:
            df, found[key] = despike(df, key, despiking[key], by_profile=True, keys=keys, tally=tally)
            df = cut(df)
    return df.drop(*(k for k in ALWAYS if not on[k])), found, [v.key for v in VARIABLES if on[v.key]]
