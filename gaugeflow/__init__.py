"""Preparing, checking, modelling and monitoring wide indicator tables on Spark."""
