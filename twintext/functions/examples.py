"""Fixed-length examples: padding, lengths and masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from twintext.params import PrepParams

_DEFAULTS = PrepParams()


def pad_tokens(
    tokens: Column,
    length: int | Column = _DEFAULTS.max_length,
    start: bool = False,
    end: bool = False,
    params: PrepParams = _DEFAULTS,
) -> Column:
    """Optional start, the tokens, optional end, padding; cut to ``length``."""
    parts = []
    if start:
        parts.append(F.array(F.lit(params.start_id)))
    parts.append(tokens)
    if end:
        parts.append(F.array(F.lit(params.end_id)))
    length = F.lit(length) if isinstance(length, int) else length
    missing = F.greatest(length - F.size(tokens), F.lit(0))
    parts.append(F.array_repeat(F.lit(params.pad_id), missing))
    return F.slice(F.concat(*parts), F.lit(1), length)


def end_is_cut(tokens: Column, length: int = _DEFAULTS.max_length) -> Column:
    """True iff padding with an end token would cut that end token away."""
    return F.size(tokens) >= length


def valid_length(padded: Column, pad_id: int = _DEFAULTS.pad_id) -> Column:
    """Position of the first padding token, the whole size if there is none."""
    first = F.array_position(padded, F.lit(pad_id)).cast("int")
    return F.when(first > 0, first - 1).otherwise(F.size(padded))


def length_mask(length: Column, size: int = _DEFAULTS.max_length) -> Column:
    """``array<tinyint>``: 1 up to the valid length, 0 on the padding."""
    visible, masked = (F.lit(v).cast("tinyint") for v in (1, 0))
    length = F.least(length, F.lit(size))
    return F.concat(F.array_repeat(visible, length), F.array_repeat(masked, size - length))


def encoder_cells(src_length: Column) -> Column:
    """Unmasked cells of the encoder's square padding mask."""
    s = src_length.cast("long")
    return s * s


def decoder_cells(tgt_length: Column) -> Column:
    """Unmasked cells under padding and strict look-ahead together."""
    t = tgt_length.cast("long")
    return F.shiftright(t * (t + 1), 1)


def cross_cells(src_length: Column, tgt_length: Column) -> Column:
    """Unmasked cells of the decoder-to-encoder mask."""
    return tgt_length.cast("long") * src_length.cast("long")


def non_pad_count(labels: Column, pad_id: int = _DEFAULTS.pad_id) -> Column:
    """Number of labels that take part in the loss."""
    return F.size(F.filter(labels, lambda x: x != pad_id))
