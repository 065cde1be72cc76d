"""The three loads: index pull, index flatten and register load."""
