"""Table operators: lazy, DataFrame in and DataFrame out."""
