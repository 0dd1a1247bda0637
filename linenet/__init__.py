"""Spark toolkit for cleaning, enriching, profiling and completing tables of linear network assets."""
