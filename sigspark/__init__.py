"""Cataloguing, describing and classifying large collections of short signals on Spark."""
