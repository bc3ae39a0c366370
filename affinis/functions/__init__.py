"""Column expressions shared by the operators (JVM-side, codegen friendly)."""

from affinis.functions.expr import (  # noqa: F401
    FEATURES,
    finite,
    is_finite_all,
    round_half_up,
    safe_div,
    title_of,
    unit_hash,
    word_count,
)
