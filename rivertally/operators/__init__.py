"""Relational operators: joins, ordered numbering, reshaping, statistics, rates, quality flags."""
