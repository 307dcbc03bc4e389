"""Longer runs made of the operators: training to registration, and batch monitoring."""
