"""Inputs, and the tables that pass from one stage to the next."""
