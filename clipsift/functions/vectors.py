"""Fixed-width float vectors as arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(c: Column) -> Column:
    return c.cast("array<double>")


def total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)


def softmax(logits: Column) -> Column:
    """Softmax of an array, shifted by its maximum."""
    raised = F.transform(as_doubles(logits), lambda x: F.exp(x - F.array_max(as_doubles(logits))))
    # One pass: the shifted exponentials and their sum are folded together.
    return F.aggregate(
        F.array(raised),
        F.lit(None).cast("array<double>"),
        lambda _, e: F.transform(e, lambda x: x / total(e)),
    )


def argmax(c: Column) -> Column:
    """0-based position of the (first) maximum."""
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def top_class(probs: Column, names: Sequence[str] | None = None) -> Column:
    """struct(label_id, confidence, label); ids without a name are called Unknown."""
    ident = argmax(probs)
    label = F.lit("Unknown")
    for i, name in enumerate(names or ()):
        label = F.when(ident == i, F.lit(name)).otherwise(label)
    return F.struct(
        ident.alias("label_id"), F.array_max(probs).alias("confidence"), label.alias("label")
    )


def prob_map(probs: Column, names: Sequence[str] | None = None) -> Column:
    """{name, or the position as text: probability}."""
    names = list(names or ())
    known = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    keys = F.transform(
        probs, lambda _, i: F.coalesce(F.get(known, i), i.cast("string"))
    )
    return F.map_from_arrays(keys, probs)


def collapse_multiclass(probs: Column) -> Column:
    """Class 0 against the rest: struct(prob, pred)."""
    return F.struct(
        (F.lit(1.0) - F.get(probs, F.lit(0))).alias("prob"),
        (argmax(probs) != 0).cast("int").alias("pred"),
    )


def select_dims(c: Column, drop: Sequence[int]) -> Column:
    dropped = F.array(*[F.lit(int(d)) for d in drop])
    return F.filter(c, lambda _, i: ~F.array_contains(dropped, i))


def fuse(*parts: Column) -> Column:
    return F.concat(*parts)


def zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), n)


def pad(c: Column, n: int) -> Column:
    """Zeros on the right up to ``n``; longer vectors stay as they are."""
    missing = F.greatest(F.lit(n) - F.size(c), F.lit(0))
    return F.concat(c, F.array_repeat(F.lit(0.0).cast("float"), missing))


def zero_fill(c: Column, n: int) -> Column:
    return F.coalesce(c, zeros(n))


def dot(c: Column, weights: Sequence[float]) -> Column:
    """Inner product with fixed weights."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    return total(F.zip_with(as_doubles(c), w, lambda a, b: a * b))
