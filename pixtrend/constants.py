"""Fixed values that must equal the reference workflow's for right results.

Everything in this module is a published constant (band naming of the
sensor, scene-classification codes, tasselled-cap coefficients, thresholds
used by the workflow).  They are listed plainly and in their natural order.
"""

# --- fixed values -----------------------------------------------------------
# Sentinel-2 asset names in stacking order.
BAND_ASSETS = ["B02_10m", "B03_10m", "B04_10m", "B08_10m", "B11_20m", "B12_20m"]
# Column names used for the six labelled bands in every table of this package.
BANDS = ["blue", "green", "red", "nir", "swir1", "swir2"]
# Scene-classification asset and its column.
SCL_ASSET = "SCL_20m"

# Scene-classification (SCL) codes.
SCL_BAD = [0, 1, 3, 7, 8, 9, 10, 11]  # blanked by the SCL mask of the median workflow
SCL_CLOUD = [3, 7, 8, 9, 10, 11]      # "invalid" set: cloud shadow, cloud, cirrus, snow

# Tasselled-cap coefficients for Sentinel-2, band order Blue, Green, Red, NIR, SWIR1, SWIR2.
TC_COEFFS = {
    "tcb": (0.3037, 0.2793, 0.4743, 0.5585, 0.5082, 0.1863),
    "tcg": (-0.2848, -0.2435, -0.5436, 0.7243, 0.0840, -0.1800),
    "tcw": (0.1509, 0.1973, 0.3279, 0.3406, -0.7112, -0.4572),
}

# Workflow thresholds.
REFLECTANCE_MAX = 10000        # uint16 packing clips to 0..10000, 0 = nodata
BRIGHT_THRESHOLD = 2100        # R, G and B all above -> blank pixel
SIGMA_K = 3                    # per-scene, per-band outlier mask: mean +- 3 sigma
LOW_THRESHOLD = 10             # low-reflectance mask threshold
LOW_MAX_VALID = 2              # blank when at least nbands - 2 bands are low
AOI_MIN_COVERAGE_RATIO = 0.4   # footprint/AOI coverage needed before reading pixels
AOI_CLOUD_THRESH = 0.5         # max cloudy share of valid AOI pixels
AOI_MIN_COVERAGE = 0.1         # min valid share of the expected AOI pixels
SCENE_MAX_CLOUD = 80           # catalogue-wide cloud cover filter of the AOI workflow
SLOPE_SCALE = 10               # slope per year -> per decade
STRETCH_LO, STRETCH_HI = -0.3, 0.3  # visual stretch range of the trend picture
QUANTILE_BY_BAND = {           # "qmix25_75" reducer: q per band
    "blue": 0.25, "green": 0.25, "red": 0.25, "nir": 0.25, "swir1": 0.75, "swir2": 0.75,
}
SEASON = ("07-01", "08-31")    # default acquisition season (MM-DD)
DEFAULT_AOI = (-153.5, 70.5, -153.0, 71.0)  # lon/lat bbox (minx, miny, maxx, maxy)
MID_SEASON = (7, 15)           # month/day stamp given to a year's mosaic
# --- end of fixed values ----------------------------------------------------

# Integer tasselled-cap coefficients (x 10^4).  The coefficients above have four
# decimals, so tc * 10^8 = sum(coef_e4 * band) is an exact integer.
TC_COEFFS_E4 = {k: tuple(int(round(c * 10000)) for c in v) for k, v in TC_COEFFS.items()}

# WGS84 ellipsoid and UTM parameters (public definitions).
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0
