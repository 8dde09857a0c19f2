"""Column helpers: paths, names, codes, licences, labels and levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- paths and names -------------------------------------------------------


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dirname(path: Column, levels: int = 1) -> Column:
    parts = F.split(path, "/")
    return F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - levels, F.lit(0))), "/")


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"\.[^.]*$", "")


def swap_extension(path: Column, extension: str) -> Column:
    return F.regexp_replace(path, r"\.[^./]*$", extension)


def tokenize_root(path: Column, root: str, token: str) -> Column:
    """Replace a leading root by its symbolic token."""
    return F.when(path.startswith(root), F.concat(F.lit(token), F.substring(path, len(root) + 1, 1 << 30))).otherwise(path)


def expand_root(path: Column, root: str, token: str) -> Column:
    return F.when(path.startswith(token), F.concat(F.lit(root), F.substring(path, len(token) + 1, 1 << 30))).otherwise(path)


def speaker_track(path: Column) -> Column:
    """Struct (speaker, track) from the last two ``_`` parts of the file stem; null parts where there are fewer."""
    parts = F.split(stem(path), "_")
    part = lambda k: F.when(F.size(parts) >= 2, F.get(parts, F.size(parts) - k))
    return F.struct(part(2).alias("speaker"), part(1).alias("track"))


def speaker_key(variant: Column, gender: Column, speaker: Column) -> Column:
    return F.concat(variant, F.lit("-"), gender, speaker)


def gender(value: Column) -> Column:
    """male, female or unknown; null for anything that is none of the known spellings."""
    v = F.regexp_replace(F.lower(F.trim(value)), "_unsure$", "")
    return F.when(value.isNull() | v.isin("nan", "unknown", ""), "unknown").when(v.isin("m", "male"), "male").when(v.isin("f", "female"), "female")


def accent(path: Column, rule: str) -> Column:
    """The accent that a path tells: ``es-ar`` by the mark of the Spanish speakers in it, ``british`` by the first two letters of the file name."""
    return F.when(path.contains("esw"), "es-es").otherwise("es-ar") if rule == "es-ar" else F.substring(basename(path), 1, 2)


def langcode(value: Column) -> Column:
    return F.lower(F.trim(value))


def padded_id(value: Column, width: int = 6) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def id_folder(value: Column, width: int = 6) -> Column:
    return F.substring(padded_id(value, width), 1, 3)


def subset_name(license_usage: Column, instrumental: Column) -> Column:
    return F.concat_ws("/", license_usage, instrumental)


def plain_name(value: Column) -> Column:
    """Characters that are not of a word become ``_``; repeats of it become one."""
    return F.regexp_replace(F.regexp_replace(value, r"[^A-Za-z0-9_]", "_"), "_+", "_")


# --- licences --------------------------------------------------------------


def _license_words(name: Column) -> Column:
    return F.concat(F.lit("-"), F.regexp_replace(F.upper(F.coalesce(name, F.lit(""))), r"[^A-Z0-9.]+", "-"), F.lit("-"))


def _license_kind(name: Column) -> Column:
    """free, cc (with attribution), unclear (a CC licence that does not name it) or null for anything else."""
    n = _license_words(name)
    is_cc = n.contains("-CC-") | n.contains("-CREATIVE-COMMONS-")
    return F.when(is_cc & n.contains("-BY-"), "cc").when(is_cc, "unclear").when(n.contains("-ART-LIBRE-"), "free")


def license_flags(name: Column) -> Column:
    """(attribution, commercial, derivative, share_alike) by what the name contains; a free-art licence is by-sa.

    All are null, so not granted, for names that are of no such licence and
    for CC names without BY.
    """
    n, kind = _license_words(name), _license_kind(name)
    flag = lambda part, there: F.when(kind == "free", True).when(kind == "cc", n.contains(f"-{part}-") == F.lit(there))
    return F.struct(flag("BY", True).alias("attribution"), flag("NC", False).alias("commercial"), flag("ND", False).alias("derivative"), flag("SA", True).alias("share_alike"))


def license_name(name: Column) -> Column:
    """The canonical name; a CC licence without BY is unclear, and null is a licence that is not known."""
    flags, kind = license_flags(name), _license_kind(name)
    parts = F.concat_ws("-", F.lit("CC"), F.when(flags["attribution"], "BY"), F.when(~flags["commercial"], "NC"), F.when(~flags["derivative"], "ND"), F.when(flags["share_alike"], "SA"))
    return F.when(kind == "free", "Art Libre").when(kind == "unclear", "Unclear CC License").when(kind == "cc", parts)


def usage_class(commercial: Column, derivative: Column) -> Column:
    """nd without derivatives, else nc without commercial use, else com; unclear flags count as no."""
    return F.when(~F.coalesce(derivative, F.lit(False)), "nd").when(~F.coalesce(commercial, F.lit(False)), "nc").otherwise("com")


def tri_state(family: Column) -> Column:
    """(commercial, derivative) as Y, N or ? by the family name; ? where it does not say."""
    f = F.lower(family)
    unclear = family.isNull() | (f == "missing") | f.contains("unclear")
    flag = lambda part: F.when(unclear, "?").when(f.contains(part), "N").otherwise("Y")
    return F.struct(flag("nc").alias("commercial"), flag("nd").alias("derivative"))


# --- labels ----------------------------------------------------------------


def label_classes(labels: Column, mapping: dict[str, str]) -> Column:
    """The distinct classes of a comma list of labels; unknown labels are dropped."""
    table = F.create_map(*[F.lit(x) for pair in sorted(mapping.items()) for x in pair])
    found = F.transform(F.split(labels, ","), lambda x: F.try_element_at(table, F.trim(x)))
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull())))


def one_class(classes: Column, version: int) -> Column:
    """One class of a set. Version 2: unusable before foreground before background. Version 3: more than one is unusable. Null if empty."""
    if version == 2:
        has = lambda c: F.array_contains(classes, c)
        return F.when(has("unusable"), "unusable").when(has("foreground"), "foreground").when(has("background"), "background")
    return F.when(F.size(classes) > 1, "unusable").when(F.size(classes) == 1, F.get(classes, F.lit(0)))


# --- levels ----------------------------------------------------------------


def linear(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 20)


def apply_gain(signal: Column, db: Column) -> Column:
    return F.transform(signal, lambda x: x * linear(db))


def clamp_level(db: Column, low: float = -70.0, high: float = -5.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), db))


def downmix(left: Column, right: Column, mode: str = "mid") -> Column:
    if mode == "left":
        return left
    if mode == "right":
        return right
    return F.zip_with(left, right, lambda a, b: (a + b) / 2)


def peak_db(signal: Column) -> Column:
    return 20 * F.log10(F.array_max(F.transform(signal, F.abs)) + 1e-8)


def power(signal: Column) -> Column:
    """Mean square of a signal."""
    return F.aggregate(signal, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) / F.size(signal)


def rms_db(signal: Column) -> Column:
    return 10 * F.log10(power(signal) + 1e-8)


def level_ratio_db(a: Column, b: Column) -> Column:
    return rms_db(a) - rms_db(b)


def gated_level(signal: Column, rate: float) -> Column:
    """Block-gated loudness of an unweighted signal: blocks of 0.4 s (all but one sample for clips under 0.8 s) with 75 % overlap,
    an absolute gate at -70 and a relative one 10 below the mean of what passes; -Infinity for silence."""
    n = F.size(signal)
    seconds = n / F.lit(float(rate))
    block = F.when(seconds >= 0.8, F.lit(0.4)).otherwise((n - 1) / F.lit(float(rate)))
    size = F.greatest(F.floor(block * rate + 1e-9), F.lit(1)).cast("int")
    step = F.greatest(F.floor(block * rate * 0.25 + 1e-9), F.lit(1)).cast("int")
    starts = F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)), step)
    powers = F.transform(starts, lambda s: F.aggregate(F.slice(signal, s + 1, size), F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")) / size)
    return _gate(powers)


def _gate(powers: Column) -> Column:
    mean = lambda xs: F.aggregate(xs, F.lit(0.0), lambda t, x: t + x) / F.size(xs)
    loud = lambda p: F.when(p > 0, 10 * F.log10(p) - 0.691).otherwise(F.lit(float("-inf")))
    first = F.filter(powers, lambda p: loud(p) > -70)
    second = F.transform(F.array(first), lambda xs: F.filter(xs, lambda p: loud(p) > loud(mean(xs)) - 10))[0]
    return F.when(F.size(second) > 0, loud(mean(second))).otherwise(F.lit(float("-inf")))
