"""Stages that chain operators into the bronze, silver and gold tables."""
