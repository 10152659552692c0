"""The arrivals star: its cleaners, its build and its questions."""
