"""DataFrame -> DataFrame operators: cleaning, station joins, merge, OD cut,
passenger flow, and the skew-safe helpers for hot card-days."""
