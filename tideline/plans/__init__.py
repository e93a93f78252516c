"""The three sets of layered tables, the event log and the risk model, as plain functions."""
