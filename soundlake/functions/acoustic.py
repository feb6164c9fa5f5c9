"""Levels, classes, raw-field decoding: pure expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soundlake import constants as K


def finite(c: Column) -> Column:
    """NaN and infinities to NULL; apply once where data enters."""
    d = c.cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(float("inf"))), None).otherwise(c)


def to_db(linear: Column) -> Column:
    """10 log10; NULL at or below 1e-12 (dropped samples)."""
    return F.when(linear > 1e-12, 10 * F.log10(linear))


def far_cutoff(channel: Column) -> Column:
    """Far angle limit from a channel or frequency name; an unknown name fails the job."""
    c = F.upper(channel)
    return (
        F.when(c.contains("HF"), F.lit(K.FAR_CUTOFF["HF"]))
        .when(c.contains("LF"), F.lit(K.FAR_CUTOFF["LF"]))
        .otherwise(F.raise_error(F.concat(F.lit("no frequency in channel "), channel)).cast("double"))
    )


def frequency_of(channels: Column) -> Column:
    """'HF' or 'LF' for an array of channel names; mixed or unknown lists fail the job."""
    hf = F.exists(channels, lambda c: F.upper(c).contains("HF"))
    lf = F.exists(channels, lambda c: F.upper(c).contains("LF"))
    return (
        F.when(hf & lf, F.raise_error(F.lit("mixed frequencies")).cast("string"))
        .when(hf, F.lit("HF"))
        .when(lf, F.lit("LF"))
        .otherwise(F.raise_error(F.lit("no frequency in channels")).cast("string"))
    )


def channels_for(freq: str) -> list[str]:
    """The two sides recorded at one frequency."""
    f = freq.upper()
    if f not in K.FAR_CUTOFF:
        raise ValueError(f"unknown frequency {freq!r}")
    return [f"{f}_{side}" for side in ("port", "stbd")]


def angle_mask(db: Column, angle: Column, far: Column) -> Column:
    """Level where the incidence angle lies in [near, far], else NULL."""
    return F.when(angle.between(F.lit(K.NEAR_CUTOFF), far), db)


def angle_weight(angle: Column) -> Column:
    """Confidence of a sample by its distance from the reference angle."""
    u = (angle - K.REFERENCE_ANGLE) / K.CONFIDENCE_SIGMA
    return F.exp(-(u * u))


def plausible_thickness(t: Column) -> Column:
    """Between the thinnest and the thickest layer a pick may show."""
    return t.between(K.THICK_MIN, K.THICK_MAX)


def water_depth(depth: Column, altitude: Column) -> Column:
    """Depth of the sensor plus its height above ground."""
    return depth + altitude


def slant_window(altitude: Column, far: Column) -> tuple[Column, Column]:
    """Slant ranges at the near and far angle limits."""
    return altitude / math.cos(math.radians(K.NEAR_CUTOFF)), altitude / F.cos(F.radians(far))


def ground_range(slant: Column, altitude: Column) -> Column:
    return F.sqrt(F.greatest(slant * slant - altitude * altitude, F.lit(0.0)))


def incidence_angle(slant: Column, altitude: Column) -> Column:
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(altitude, slant)))))


def accept_altitude(first_return: Column, seabed: Column, depth: Column, ceiling: Column, floor: float = 5.0) -> Column:
    """First return if plausible, else seabed minus towfish depth if plausible, else NULL."""
    from_seabed = F.when(depth > 0, seabed - depth)

    def ok(a: Column) -> Column:
        return F.when((a > floor) & (a < ceiling), a)

    return F.coalesce(ok(first_return), ok(from_seabed))


def bottom_index(amps: Column, blanking: int = K.BLANKING) -> Column:
    """0-based position of the largest sample after blanking; the first on ties."""
    tail = F.slice(amps, F.lit(blanking + 1), F.greatest(F.size(amps) - blanking, F.lit(0)))
    return F.when(
        F.size(amps) > blanking,
        (F.array_position(tail, F.array_max(tail)) - 1 + blanking).cast("int"),
    )


def reflection_loss(amp_bottom: Column, cc: float, n_samples: Column, min_samples: int = 100) -> Column:
    """-20 log10(A/cc) clipped; NULL for non-positive amplitudes or short traces."""
    if cc <= 0:
        return F.lit(None).cast("double")
    rl = -20 * F.log10(amp_bottom / cc)
    return F.when(
        (amp_bottom > 0) & (n_samples >= min_samples),
        F.greatest(F.lit(K.RL_MIN), F.least(F.lit(K.RL_MAX), rl)),
    )


def sediment_table(spark: SparkSession, sound_speed: float = K.SOUND_SPEED) -> DataFrame:
    """Seven classes with reflection loss and upper class limit, strongest reflector first."""
    zw = K.WATER_DENSITY * sound_speed
    rows = []
    for name, rho, vp in K.SEDIMENTS:
        z = rho * vp
        rows.append((name, float(rho), vp, -20 * math.log10(max(abs((z - zw) / (z + zw)), 1e-10))))
    rows.sort(key=lambda r: r[3])
    out = []
    for i, (name, rho, vp, rl) in enumerate(rows):
        upper = (rl + rows[i + 1][3]) / 2 if i + 1 < len(rows) else None
        out.append((i, name, rho, vp, rl, upper, K.SEDIMENT_COLORS[i], K.SEDIMENT_LABELS[i], K.CLASS_THICKNESS[i]))
    return spark.createDataFrame(
        out,
        "class_id int, name string, density double, vp double, rl_db double, upper_db double, "
        "color string, label string, thickness double",
    )


def class_limits(sound_speed: float = K.SOUND_SPEED) -> list[float]:
    """The six inner class limits in dB."""
    zw = K.WATER_DENSITY * sound_speed
    rl = sorted(-20 * math.log10(abs((r * v - zw) / (r * v + zw))) for _, r, v in K.SEDIMENTS)
    return [(a + b) / 2 for a, b in zip(rl, rl[1:])]


def sediment_class(rl: Column, sound_speed: float = K.SOUND_SPEED) -> Column:
    """Class id of a reflection loss: -1 if NULL or negative, else how many limits it reached."""
    n = sum(((rl >= t).cast("int") for t in class_limits(sound_speed)), F.lit(0))
    return F.when(rl.isNull() | (rl < 0), F.lit(-1)).otherwise(n)


def class_label(class_id: Column) -> Column:
    """Display label; ids off the palette become 'class N'."""
    labels = F.array(*[F.lit(s) for s in K.SEDIMENT_LABELS])
    inside = class_id.between(0, len(K.SEDIMENT_LABELS) - 1)
    return F.when(inside, F.get(labels, class_id)).otherwise(F.concat(F.lit("class "), class_id.cast("string")))


def hex_channel(color: Column, channel: int) -> Column:
    """Red (0), green (1) or blue (2) of '#RRGGBB'."""
    return F.conv(F.substring(color, 2 + 2 * channel, 2), 16, 10).cast("int")


def null_sentinel(v: Column, dtype: str) -> Column:
    """Categorical nodata to NULL: 255 for uint8, -1 for int8."""
    bad = {"uint8": 255, "int8": -1}.get(dtype)
    return v if bad is None else F.when(v != bad, v)


def to_byte(v: Column, lo: Column, hi: Column) -> Column:
    """Min-max to 0..255 by truncation; a flat range gives 0."""
    return F.when(hi > lo, ((v - lo) / (hi - lo) * 255).cast("int")).otherwise(F.lit(0))


def stretch01(v: Column, lo: Column, hi: Column) -> Column:
    """Percentile stretch clipped to [0, 1]."""
    u = (v - lo) / F.greatest(hi - lo, F.lit(1e-6))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), u))


# --- raw record fields ---------------------------------------------------------------


def has_bit(flags: Column, bit: int) -> Column:
    return F.shiftright(flags, bit).bitwiseAND(1) == 1


def raw_longitude_latitude(x: Column, y: Column, units: Column, valid: Column) -> tuple[Column, Column]:
    """Raw navigation integers to degrees: unit 2 is 1/600000 degree, unit 1 is 1/1000."""
    scale = F.when(units == 2, F.lit(600000.0)).when(units == 1, F.lit(1000.0))
    use = valid & (x != 0)
    return F.when(use, x / scale), F.when(use, y / scale)


def chirp_frequency(msb: Column, low: Column, nibble: int) -> Column:
    """20-bit frequency in Hz: a nibble of ``msb`` over 16 low bits, in units of 10 Hz."""
    high = F.shiftright(msb, 4 * nibble).bitwiseAND(0xF)
    return F.shiftleft(high, 16).bitwiseOR(low) * 10


def sweep_millis(whole: Column, lsb2: Column) -> Column:
    """Sweep length: whole milliseconds plus a 10-bit microsecond field."""
    return whole + F.shiftright(lsb2, 4).bitwiseAND(0x3FF) / 1000.0


def centre_frequency(centre: Column, start10: Column, end10: Column) -> Column:
    return F.when(centre > 0, centre.cast("double")).otherwise((start10 * 10 + end10 * 10) / 2.0)


def scaled_envelope(raw: Column, data_format: Column, weight: Column) -> Column:
    """16-bit words to amplitudes: I/Q pairs (formats 1 and 9) by magnitude, else absolute value."""
    scale = F.pow(F.lit(2.0), -weight)
    pairs = (F.size(raw) / 2).cast("int")
    iq = F.transform(
        F.sequence(F.lit(0), pairs - 1),
        lambda i: F.hypot(F.get(raw, 2 * i) * scale, F.get(raw, 2 * i + 1) * scale).cast("float"),
    )
    one = F.transform(raw, lambda r: (F.abs(r).cast("double") * scale).cast("float"))
    return F.when(data_format.isin(1, 9) & (F.size(raw) % 2 == 0) & (F.size(raw) > 0), iq).otherwise(one)


def nmea_degrees(value: Column, hemisphere: Column) -> Column:
    """ddmm.mmmm text to signed degrees; unparsable text is NULL."""
    v = value.try_cast("double")
    deg = F.floor(F.abs(v) / 100) * F.signum(v)
    d = deg + (v - deg * 100) / 60.0
    return F.when(hemisphere.isin("S", "W"), -d).otherwise(d)


def nmea_position(sentence: Column) -> tuple[Column, Column]:
    """(lat, lon) of a GGA (six fields or more) or RMC (nine or more) sentence, else NULL."""
    p = F.split(F.trim(sentence), ",")
    kind = F.get(p, F.lit(0))
    gga = kind.contains("GGA") & (F.size(p) >= 6)
    rmc = kind.contains("RMC") & (F.size(p) >= 9)

    def at(i: int) -> Column:
        return nmea_degrees(F.get(p, F.lit(i)), F.get(p, F.lit(i + 1)))

    lat = F.when(gga, at(2)).when(rmc, at(3))
    lon = F.when(gga, at(4)).when(rmc, at(5))
    return lat, lon
