"""Label vocabularies and remaps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipsift.functions.counts import strip

# Label strings of the four-class vocabulary.
LABEL_IDS = {
    0: ("safe",),
    1: ("adult", "adult content", "adult-content"),
    2: ("harmful", "harmful content", "not safe", "unsafe"),
    3: ("suicide", "self-harm", "self harm", "suicidal"),
}
DEFAULT_LABEL = 2
UNLABELLED = -1

# Annotation choices and their ids in the four-class vocabulary.
ANNOTATION_IDS = {"SAFE": 0, "NOT SAFE": 2}

# Display names and the name of an absent label.
SERVING_NAMES = ("Safe", "Harmful")
UNKNOWN = "Unknown"

# Folder names and their slugs.
FOLDER_SLUGS = {
    "Adult Content": "adult",
    "Harmful Content": "harmful",
    "Safe": "safe",
    "Suicide": "suicide",
}


def map_label(c: Column) -> Column:
    """Label string -> 0..3; unknown strings count as generic harmful, null stays null."""
    text = F.lower(strip(c))
    out = F.when(c.isNull(), F.lit(None).cast("int"))
    for ident, names in LABEL_IDS.items():
        if ident != DEFAULT_LABEL:
            out = out.when(text.isin(*names), F.lit(ident))
    return out.otherwise(F.lit(DEFAULT_LABEL))


def annotation_label(choice: Column) -> Column:
    """Annotation choice -> four-class id; other choices -> null."""
    out = F.lit(None).cast("int")
    for name, ident in ANNOTATION_IDS.items():
        out = F.when(choice == name, F.lit(ident)).otherwise(out)
    return out


def verification_label(choice: Column) -> Column:
    """Annotation choice -> 0 for SAFE, 1 for anything else."""
    return F.when(choice == "SAFE", F.lit(0)).when(choice.isNotNull(), F.lit(1))


def finetune_label(c: Column) -> Column:
    """Two-class training target: only class 2 is positive."""
    return (c == 2).cast("int")


def binary_label(c: Column) -> Column:
    """Two-class evaluation target: every class above 0 is positive."""
    return (c > 0).cast("int")


def display_label(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(UNKNOWN))


def folder_slug(c: Column) -> Column:
    out = F.lower(F.replace(c, F.lit(" "), F.lit("_")))
    for folder, slug in FOLDER_SLUGS.items():
        out = F.when(c == folder, F.lit(slug)).otherwise(out)
    return out


# Upper bounds of the agreement bands.
KAPPA_BANDS = (
    (0.20, "slight"),
    (0.40, "fair"),
    (0.60, "moderate"),
    (0.80, "substantial"),
)


def kappa_band(c: Column) -> Column:
    out = F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string")).when(c < 0, "poor")
    for bound, name in KAPPA_BANDS:
        out = out.when(c <= bound, name)
    return out.otherwise("almost perfect")
