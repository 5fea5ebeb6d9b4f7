"""Seawater properties (TEOS-10, PSS-78) as Spark columns.

Polynomials are tables of coefficients, so a column, a derivative and a number for tests come from one place. Functions
take and return columns; those that iterate add their steps as columns of a DataFrame, because an expression that is
used many times over would otherwise be copied into the plan each time.

Units: conductivity mS/cm, temperature degrees Celsius (ITS-90), pressure dbar, Absolute Salinity g/kg.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Constants of the thermodynamic equation of seawater.
SFAC = 0.0248826675584615
OFFSET = 0.5971840214030754  #: 24 g/kg times SFAC
CP0 = 3991.86795711963
SSO = 35.16504
UPS = SSO / 35.0

# Specific volume (Roquet et al. 2015), powers of (sqrt salinity, temperature, pressure).
SPECVOL = {
    (0, 0, 0): 1.0769995862e-3, (0, 0, 1): -6.0799143809e-5, (0, 0, 2): 9.9856169219e-6, (0, 0, 3): -1.1309361437e-6, (0, 0, 4): 1.0531153080e-7, (0, 0, 5): -1.2647261286e-8, (0, 0, 6): 1.9613503930e-9,
    (0, 1, 0): -1.5649734675e-5, (0, 1, 1): 1.8505765429e-5, (0, 1, 2): -1.1736386731e-6, (0, 1, 3): -3.6527006553e-7, (0, 1, 4): 3.1454099902e-7,
    (0, 2, 0): 2.7762106484e-5, (0, 2, 1): -1.1716606853e-5, (0, 2, 2): 2.1305028740e-6, (0, 2, 3): 2.8695905159e-7,
    (0, 3, 0): -1.6521159259e-5, (0, 3, 1): 7.9279656173e-6, (0, 3, 2): -4.6132540037e-7,
    (0, 4, 0): 6.9111322702e-6, (0, 4, 1): -3.4102187482e-6, (0, 4, 2): -6.3352916514e-8,
    (0, 5, 0): -8.0539615540e-7, (0, 5, 1): 5.0736766814e-7, (0, 6, 0): 2.0543094268e-7,
    (1, 0, 0): -3.1038981976e-4, (1, 0, 1): 2.4262468747e-5, (1, 0, 2): -5.8484432984e-7, (1, 0, 3): 3.6310188515e-7, (1, 0, 4): -1.1147125423e-7,
    (1, 1, 0): 3.5009599764e-5, (1, 1, 1): -9.5677088156e-6, (1, 1, 2): -5.5699154557e-6, (1, 1, 3): -2.7295696237e-7,
    (1, 2, 0): -3.7435842344e-5, (1, 2, 1): -2.3678308361e-7, (1, 2, 2): 3.9137387080e-7,
    (1, 3, 0): 2.4141479483e-5, (1, 3, 1): -3.4558773655e-6, (1, 3, 2): 7.7618888092e-9,
    (1, 4, 0): -8.7595873154e-6, (1, 4, 1): 1.2956717783e-6, (1, 5, 0): -3.3052758900e-7,
    (2, 0, 0): 6.6928067038e-4, (2, 0, 1): -3.4792460974e-5, (2, 0, 2): -4.8122251597e-6, (2, 0, 3): 1.6746303780e-8,
    (2, 1, 0): -4.3592678561e-5, (2, 1, 1): 1.1100834765e-5, (2, 1, 2): 5.4620748834e-6,
    (2, 2, 0): 3.5907822760e-5, (2, 2, 1): 2.9283346295e-6, (2, 2, 2): -6.5731104067e-7,
    (2, 3, 0): -1.4353633048e-5, (2, 3, 1): 3.1655306078e-7, (2, 4, 0): 4.3703680598e-6,
    (3, 0, 0): -8.5047933937e-4, (3, 0, 1): 3.7470777305e-5, (3, 0, 2): 4.9263106998e-6,
    (3, 1, 0): 3.4532461828e-5, (3, 1, 1): -9.8447117844e-6, (3, 1, 2): -1.3544185627e-6,
    (3, 2, 0): -1.8698584187e-5, (3, 2, 1): -4.8826139200e-7, (3, 3, 0): 2.2863324556e-6,
    (4, 0, 0): 5.8086069943e-4, (4, 0, 1): -1.7322218612e-5, (4, 0, 2): -1.7811974727e-6,
    (4, 1, 0): -1.1959409788e-5, (4, 1, 1): 2.5909225260e-6, (4, 2, 0): 3.8595339244e-6,
    (5, 0, 0): -2.1092370507e-4, (5, 0, 1): 3.0927427253e-6, (5, 1, 0): 1.3864594581e-6, (6, 0, 0): 3.1932457305e-5,
}

# Potential enthalpy (IOC et al. 2010), powers of (sqrt salinity, temperature).
POTENTIAL_ENTHALPY = {
    (0, 0, 0): 61.01362420681071, (0, 1, 0): 168776.46138048015, (0, 2, 0): -2735.2785605119625, (0, 3, 0): 2574.2164453821433, (0, 4, 0): -1536.6644434977543, (0, 5, 0): 545.7340497931629, (0, 6, 0): -50.91091728474331, (0, 7, 0): -18.30489878927802,
    (2, 0, 0): 268.5520265845071, (2, 1, 0): -12019.028203559312, (2, 2, 0): 3734.858026725145, (2, 3, 0): -2046.7671145057618, (2, 4, 0): 465.28655623826234, (2, 5, 0): -0.6370820302376359, (2, 6, 0): -10.650848542359153,
    (3, 0, 0): 937.2099110620707, (3, 1, 0): 588.1802812170108, (3, 2, 0): 248.39476522971285, (3, 3, 0): -3.871557904936333, (3, 4, 0): -2.6268019854268356,
    (4, 0, 0): -1687.914374187449, (4, 1, 0): 936.3206544460336, (4, 2, 0): -942.7827304544439, (4, 3, 0): 369.4389437509002, (4, 4, 0): -33.83664947895248, (4, 5, 0): -9.987880382780322,
    (5, 0, 0): 246.9598888781377, (6, 0, 0): 123.59576582457964, (7, 0, 0): -48.5891069025409,
}

# The part of entropy that depends on temperature or pressure (IOC et al. 2010), times -40.
ENTROPY = {
    (0, 0, 1): -270.983805184062, (0, 0, 2): 776.153611613101, (0, 0, 3): -196.51255088122, (0, 0, 4): 28.9796526294175, (0, 0, 5): -2.13290083518327,
    (0, 1, 0): -24715.571866078, (0, 1, 1): 2910.0729080936, (0, 1, 2): -1513.116771538718, (0, 1, 3): 546.959324647056, (0, 1, 4): -111.1208127634436, (0, 1, 5): 8.68841343834394,
    (0, 2, 0): 2210.2236124548363, (0, 2, 1): -2017.52334943521, (0, 2, 2): 1498.081172457456, (0, 2, 3): -718.6359919632359, (0, 2, 4): 146.4037555781616, (0, 2, 5): -4.9892131862671505,
    (0, 3, 0): -592.743745734632, (0, 3, 1): 1591.873781627888, (0, 3, 2): -1207.261522487504, (0, 3, 3): 608.785486935364, (0, 3, 4): -105.4993508931208,
    (0, 4, 0): 290.12956292128547, (0, 4, 1): -973.091553087975, (0, 4, 2): 602.603274510125, (0, 4, 3): -276.361526170076, (0, 4, 4): 32.40953340386105,
    (0, 5, 0): -113.90630790850321, (0, 5, 1): 381.06836198507096, (0, 5, 2): -133.7383902842754, (0, 5, 3): 49.023632509086724, (0, 6, 0): 21.35571525415769, (0, 6, 1): -67.41756835751434,
    (2, 0, 1): 729.116529735046, (2, 0, 2): -343.956902961561, (2, 0, 3): 124.687671116248, (2, 0, 4): -31.656964386073, (2, 0, 5): 7.04658803315449,
    (2, 1, 0): 1760.062705994408, (2, 1, 1): -1721.528607567954, (2, 1, 2): 674.819060538734, (2, 1, 3): -356.629112415276, (2, 1, 4): 88.4080716616, (2, 1, 5): -15.84003094423364,
    (2, 2, 0): -675.802947790203, (2, 2, 1): 2082.7344423998043, (2, 2, 2): -614.668925894709, (2, 2, 3): 340.685093521782, (2, 2, 4): -33.3848202979239,
    (2, 3, 0): 365.7041791005036, (2, 3, 1): -1190.914967948748, (2, 3, 2): 298.904564555024, (2, 3, 3): -145.9491676006352, (2, 4, 0): -108.30162043765552, (2, 5, 0): 12.78101825083098,
    (3, 0, 1): -175.292041186547, (3, 0, 2): 83.1923927801819, (3, 0, 3): -29.483064349429,
    (3, 1, 0): -86.1329351956084, (3, 1, 1): 766.116132004952, (3, 1, 2): -108.3834525034224, (3, 1, 3): 51.2796974779828, (3, 2, 0): -30.0682112585625, (3, 2, 1): -1380.9597954037708, (3, 3, 0): 3.50240264723578, (3, 3, 1): 938.26075044542,
    (4, 0, 1): -22.6683558512829, (4, 1, 0): -137.1145018408982, (4, 2, 0): 148.10030845687618, (4, 3, 0): -68.5590309679152, (4, 4, 0): 12.4848504784754,
}

# Spiciness at the surface (McDougall and Krzysik 2015); a row for each power of sqrt salinity, by powers of temperature.
SPICINESS0 = [
    [-9.22982898371678e1, -1.35727873628866e1, 1.87353650994010e1, -1.61360047373455e1, 3.76112762286425e1, -4.27086671461257e1, 2.00820111041594e1],
    [2.87969717584045e2, 1.13747111959674e1, 6.07377192990680e1, -7.37514033570187e1, -7.51171878953574e1, 1.63310989721504e2, -8.83222751638095e1],
    [-6.41725302237048e2, 2.79732530789261e1, -2.49466901993728e2, 3.26691295035416e2, 2.66389243708181e1, -2.93170905757579e2, 1.76053907144524e2],
    [8.27634318120224e2, -7.02156220126926e1, 3.82973336590803e2, -5.06206828083959e2, 6.69626565169529e1, 3.02851235050766e2, -1.96345285604621e2],
    [-5.74040806713526e2, 7.03285905478333e1, -2.97870298879716e2, 3.88340373735118e2, -8.29188936089122e1, -1.87602137195354e2, 1.27096944425793e2],
    [2.11671167892147e2, -3.15140919876285e1, 1.16458864953602e2, -1.50029730802344e2, 3.76293848660589e1, 6.47247424373200e1, -4.47159994408867e1],
    [-3.23533339449055e1, 5.30648562097667, -1.82051249177948e1, 2.33184351090495e1, -6.22909903460368, -9.55975464301446, 6.61877073960113],
]
SPICE = {(i, j, 0): c for i, row in enumerate(SPICINESS0) for j, c in enumerate(row)}

# Freezing Conservative Temperature of air-free seawater, powers of (sqrt of SA / 100, p / 10000).
FREEZING = {
    (0, 0, 0): 0.017947064327968736, (2, 0, 0): -6.076099099929818, (3, 0, 0): 4.883198653547851, (4, 0, 0): -11.88081601230542, (5, 0, 0): 13.34658511480257, (6, 0, 0): -8.722761043208607, (7, 0, 0): 2.082038908808201,
    (0, 0, 1): -7.389420998107497, (0, 0, 2): -2.110913185058476, (0, 0, 3): 0.2295491578006229,
    (2, 0, 1): -0.9891538123307282, (3, 0, 1): -0.08987150128406496, (2, 0, 2): 0.3831132432071728, (4, 0, 1): 1.054318231187074, (3, 0, 2): 1.065556599652796, (2, 0, 3): -0.7997496801694032,
    (5, 0, 1): 0.3850133554097069, (4, 0, 2): -2.078616693017569, (3, 0, 3): 0.8756340772729538, (6, 0, 1): -2.079022768390933, (5, 0, 2): 1.596435439942262, (4, 0, 3): 0.1338002171109174, (7, 0, 1): 1.242891021876471,
}

# PSS-78, its extension to low salinities (Hill et al. 1986), and oxygen solubility (Garcia and Gordon 1992).
PSS_A = [0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081]
PSS_B = [0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144]
PSS_C = [0.6766097, 2.00564e-2, 1.104259e-4, -6.9698e-7, 1.0031e-9]
PSS_D = [3.426e-2, 4.464e-4, 4.215e-1, -3.107e-3]
PSS_E = [2.070e-5, -6.370e-10, 3.989e-15]
PSS_K = 0.0162
C3515 = 42.9140
O2_A = [5.80871, 3.20291, 4.17887, 5.10006, -9.86643e-2, 3.80369]
O2_B = [-7.01577e-3, -7.70028e-3, -1.13864e-2, -9.51519e-3]
O2_C = -2.75915e-7


def _not_negative(x: Column) -> Column:
    """x, 0 for a negative one; greatest() would make a missing value 0."""
    return F.when(x > 0, x).otherwise(F.when(x.isNotNull(), F.lit(0.0)))


def horner(coefs, x):
    out = coefs[-1]
    for c in coefs[-2::-1]:
        out = out * x + c
    return out


def polynomial(table: dict, x, y, z):
    """The sum of c * x^i * y^j * z^k, nested; for columns, numbers or arrays."""
    by: dict[int, dict[int, dict[int, float]]] = {}
    for (i, j, k), c in table.items():
        by.setdefault(i, {}).setdefault(j, {})[k] = c
    full = lambda d, f: [f(d[n]) if n in d else 0.0 for n in range(max(d) + 1)]
    return horner(full(by, lambda b: horner(full(b, lambda a: horner(full(a, lambda c: c), z)), y)), x)


def derivative(table: dict, axis: int) -> dict:
    """The coefficients of the derivative by x (0), y (1) or z (2)."""
    out = {}
    for key, c in table.items():
        if key[axis]:
            out[tuple(p - (n == axis) for n, p in enumerate(key))] = c * key[axis]
    return out


def _xyz(sa, ct, p, sqrt=F.sqrt):
    return sqrt(SFAC * sa + OFFSET), ct * 0.025, p * 1e-4


def specvol(sa, ct, p, sqrt=F.sqrt):
    return polynomial(SPECVOL, *_xyz(sa, ct, p, sqrt))


def rho(sa: Column, ct: Column, p: Column) -> Column:
    return 1.0 / specvol(sa, ct, p)


def sigma0(sa: Column, ct: Column) -> Column:
    return 1.0 / specvol(sa, ct, F.lit(0.0)) - 1000.0


def sound_speed(sa: Column, ct: Column, p: Column) -> Column:
    v, dv = specvol(sa, ct, p), polynomial(derivative(SPECVOL, 2), *_xyz(sa, ct, p))
    return 1e4 * F.sqrt(-v * v / dv)


def alpha(sa: Column, ct: Column, p: Column) -> Column:
    """Thermal expansion by Conservative Temperature."""
    return 0.025 * polynomial(derivative(SPECVOL, 1), *_xyz(sa, ct, p)) / specvol(sa, ct, p)


def beta(sa: Column, ct: Column, p: Column) -> Column:
    """Saline contraction at constant Conservative Temperature."""
    x, y, z = _xyz(sa, ct, p)
    return -0.5 * SFAC * polynomial(derivative(SPECVOL, 0), x, y, z) / (x * specvol(sa, ct, p))


def spiciness0(sa: Column, ct: Column) -> Column:
    return polynomial(SPICE, *_xyz(sa, ct, F.lit(0.0)))


def ct_freezing(sa: Column, p: Column) -> Column:
    """The published polynomial for air-free water, within 6e-4 K of the exact value."""
    return polynomial(FREEZING, F.sqrt(sa * 1e-2), F.lit(0.0), p * 1e-4)


def z_from_p(p: Column, lat: Column) -> Column:
    """Height, negative in water: gravity by latitude and depth, and the enthalpy of standard seawater at 0 degrees."""
    x0 = (SFAC * SSO + OFFSET) ** 0.5
    powers: dict[int, float] = {}
    for (i, j, k), c in SPECVOL.items():
        if j == 0:
            powers[k] = powers.get(k, 0.0) + c * x0**i
    z = p * 1e-4
    enthalpy = 1e8 * z * horner([powers[k] / (k + 1) for k in range(max(powers) + 1)], z)
    s2 = F.pow(F.sin(F.radians(lat)), F.lit(2.0))
    b = 9.780327 * (1.0 + (5.2792e-3 + 2.32e-5 * s2) * s2)
    a = -0.5 * 2.26e-7 * b
    return -2.0 * enthalpy / (b + F.sqrt(b * b - 4.0 * a * enthalpy))


def sa_from_sp(sp: Column, delta: Column | float = 0.0) -> Column:
    """Absolute from Practical Salinity. delta: the anomaly ratio of the place, 0 for reference composition. Negative salinities are 0."""
    return UPS * _not_negative(sp) * (1.0 + delta)


def sp_from_sa(sa: Column, delta: Column | float = 0.0) -> Column:
    return sa / (UPS * (1.0 + delta))


def ct_from_pt(sa: Column, pt: Column) -> Column:
    return polynomial(POTENTIAL_ENTHALPY, F.sqrt(SFAC * _not_negative(sa)), pt * 0.025, F.lit(0.0)) / CP0


def entropy_part(sa: Column, t: Column, p: Column | float) -> Column:
    z = p * 1e-4 if isinstance(p, Column) else F.lit(p * 1e-4)
    return -0.025 * polynomial(ENTROPY, F.sqrt(SFAC * _not_negative(sa)), t * 0.025, z)


def _entropy_slope(sa: Column, t: Column) -> Column:
    return -0.025 * 0.025 * polynomial(derivative(ENTROPY, 1), F.sqrt(SFAC * _not_negative(sa)), t * 0.025, F.lit(0.0))


def with_sp_from_c(df: DataFrame, out: str, c: str, t: str, p: str) -> DataFrame:
    """Adds Practical Salinity. Values under 2 follow Hill et al., scaled to join at 2; a negative ratio gives null."""
    t68 = F.col(t) * 1.00024
    steps = {"_t68": t68, "_f": (t68 - 15.0) / (1.0 + PSS_K * (t68 - 15.0)), "_r": F.col(c) / C3515}
    df = df.withColumns(steps)
    pressure = 1.0 + F.col(p) * horner(PSS_E, F.col(p)) / (1.0 + PSS_D[0] * F.col("_t68") + PSS_D[1] * F.col("_t68") ** 2 + (PSS_D[2] + PSS_D[3] * F.col("_t68")) * F.col("_r"))
    df = df.withColumn("_rt", F.col("_r") / (pressure * horner(PSS_C, F.col("_t68")))).withColumn("_x", F.when(F.col("_rt") >= 0, F.sqrt("_rt")))
    sp = lambda x, f: horner(PSS_A, x) + f * horner(PSS_B, x)
    slope = lambda x, f: horner([n * a for n, a in enumerate(PSS_A)][1:], x) + f * horner([n * b for n, b in enumerate(PSS_B)][1:], x)
    x, f = F.col("_x"), F.col("_f")
    df = df.withColumns({"_sp": sp(x, f), "_x2": 0.2641 + 2.0e-4 * F.col("_t68")})
    for _ in range(3):  # Newton for the ratio at salinity 2
        df = df.withColumn("_x2", F.col("_x2") - (sp(F.col("_x2"), f) - 2.0) / slope(F.col("_x2"), f))
    low = lambda s, y: s - PSS_A[0] / (1.0 + 400.0 * y * y * (1.5 + 400.0 * y * y)) - PSS_B[0] * f / (1.0 + 10.0 * y * (1.0 + 10.0 * y * (1.0 + 10.0 * y)))
    hill = low(F.col("_sp"), x) * 2.0 / low(F.lit(2.0), F.col("_x2"))
    return df.withColumn(out, F.greatest(F.when(F.col("_sp") < 2, hill).otherwise(F.col("_sp")), F.when(x.isNotNull(), F.lit(0.0)))).drop("_t68", "_f", "_r", "_rt", "_x", "_sp", "_x2")


def with_pt0_from_t(df: DataFrame, out: str, sa: str, t: str, p: str) -> DataFrame:
    """Adds potential temperature at the surface: a polynomial start, then two modified Newton steps on entropy."""
    s, tt, pp = _not_negative(F.col(sa)), F.col(t), F.col(p)
    s1 = s / UPS
    start = tt + pp * (8.65483913395442e-6 - s1 * 1.41636299744881e-6 - pp * 7.38286467135737e-9 + tt * (-8.38241357039698e-6 + s1 * 2.83933368585534e-8 + tt * 1.77803965218656e-8 + pp * 1.71155619208233e-10))
    df = df.withColumns({"_pt": start, "_true": entropy_part(s, tt, pp)})
    df = df.withColumn("_slope", CP0 / ((273.15 + F.col("_pt")) * (1.0 - 0.05 * (1.0 - s / SSO))))
    for _ in range(2):
        df = df.withColumn("_d", entropy_part(s, F.col("_pt"), 0.0) - F.col("_true"))
        df = df.withColumn("_mid", F.col("_pt") - 0.5 * F.col("_d") / F.col("_slope"))
        df = df.withColumn("_slope", _entropy_slope(s, F.col("_mid")))
        df = df.withColumn("_pt", F.col("_pt") - F.col("_d") / F.col("_slope"))
    return df.withColumn(out, F.col("_pt")).drop("_pt", "_true", "_slope", "_d", "_mid")


def with_ct_from_t(df: DataFrame, out: str, sa: str, t: str, p: str) -> DataFrame:
    """Adds Conservative Temperature."""
    return with_pt0_from_t(df, "_pt0", sa, t, p).withColumn(out, ct_from_pt(F.col(sa), F.col("_pt0"))).drop("_pt0")


def with_pt_from_ct(df: DataFrame, out: str, sa: str, ct: str) -> DataFrame:
    """Adds potential temperature from Conservative Temperature by four Newton steps."""
    s = _not_negative(F.col(sa))
    slope = lambda pt: 0.025 * polynomial(derivative(POTENTIAL_ENTHALPY, 1), F.sqrt(SFAC * s), pt * 0.025, F.lit(0.0)) / CP0
    df = df.withColumn("_pt", F.col(ct))
    for _ in range(4):
        df = df.withColumn("_pt", F.col("_pt") - (ct_from_pt(s, F.col("_pt")) - F.col(ct)) / slope(F.col("_pt")))
    return df.withColumn(out, F.col("_pt")).drop("_pt")


def o2sol(sp: Column, pt: Column) -> Column:
    """Oxygen at saturation, umol/kg."""
    pt68 = pt * 1.00024
    y = F.log((298.15 - pt68) / (273.15 + pt68))
    return F.exp(horner(O2_A, y) + sp * (horner(O2_B, y) + O2_C * sp))


def with_o2sol(df: DataFrame, out: str, sa: str, ct: str, delta: Column | float = 0.0) -> DataFrame:
    df = with_pt_from_ct(df, "_ptc", sa, ct)
    return df.withColumn(out, o2sol(sp_from_sa(F.col(sa), delta), F.col("_ptc"))).drop("_ptc")
