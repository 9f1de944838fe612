"""Operators: every one takes and returns DataFrames and receives its columns,
rules, labels and limits as arguments."""
