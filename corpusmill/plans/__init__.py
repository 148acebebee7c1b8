"""Whole-table plans shared by several operators: global order, greedy cuts, skewed joins."""
