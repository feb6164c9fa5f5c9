"""Survey constants every operator takes its defaults from."""

# Acoustics and geometry.
SOUND_SPEED = 1489.073
SAMPLE_NS = 20480
EARTH_RADIUS_M = 6_371_000.0

# Side-scan angles (degrees) and their per-frequency far limits.
REFERENCE_ANGLE = 45.0
CONFIDENCE_SIGMA = 12.0
NEAR_CUTOFF = 15.0
FAR_CUTOFF = {"HF": 65.0, "LF": 70.0}
ANGLE_MIN, ANGLE_MAX = 20.0, 70.0

# Turn filter.
MAX_ROLL = 3.0
MAX_HEADING_RATE = 2.0
MAX_HEADING_STEP = 3.0

# Altitude filter.
KALMAN_Q, KALMAN_R, KALMAN_P0, KALMAN_GATE = 0.01, 9.0, 10.0, 3.0

# Sub-bottom traces.
BLANKING = 50
RL_MIN, RL_MAX = 0.0, 50.0
BLIND_ZONE_M, MAX_DEPTH_M = 0.15, 4.0
DRAFT_M, MULTIPLE_M = 1.04, 0.15
THICK_MIN, THICK_MAX = 0.1, 3.0

# Sediment classes as (name, density kg/m3, sound speed m/s).
SEDIMENTS = [
    ("Sand", 1943, 1776.0),
    ("Silty sand / Sandy silt", 1772, 1660.5),
    ("Silt", 1740, 1627.5),
    ("Sand-silt-clay", 1596, 1590.0),
    ("Clayey silt / Silty clay", 1455, 1545.0),
    ("Partially consolidated mud", 1320, 1480.0),
    ("Fluid mud", 1183, 1444.0),
]
WATER_DENSITY = 997.0

# Display palette and labels by class id.
SEDIMENT_COLORS = ["#A0522D", "#CD853F", "#DEB887", "#BDB76B", "#8FBC8F", "#6495ED", "#2E5C8A"]
SEDIMENT_LABELS = [
    "Coarse sand",
    "Fine sand / Silty sand",
    "Silt / Sandy silt",
    "Sand-silt-clay",
    "Compacted mud",
    "Clayey silt / Silty clay",
    "Fluid mud",
]

# Modelled thickness (m) by class id.
CLASS_THICKNESS = [0.05, 0.15, 0.30, 0.50, 0.80, 1.20, 2.00]

# Magnetometer.
MAG_QUALITY, MAG_TOLERANCE = 90, 0.10
MAG_BG_WINDOW, MAG_ANOM_WINDOW = 35, 5
LAYBACK_M = 10.0

# Transverse Mercator zone (GRS80 ellipsoid, central meridian 121 E).
TM_A = 6378137.0
TM_F = 1 / 298.257222101
TM_LON0 = 121.0
TM_K0 = 0.9999
TM_FE = 250000.0
