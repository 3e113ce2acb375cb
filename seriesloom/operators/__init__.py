"""Operators over tables of series; each returns a lazy DataFrame unless it says otherwise."""
