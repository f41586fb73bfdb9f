"""Keyed views of weather and bike-station feeds, as Spark DataFrame functions."""
