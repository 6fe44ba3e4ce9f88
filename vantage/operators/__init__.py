"""Distributed operators: every function maps DataFrame(s) to a lazy DataFrame."""
