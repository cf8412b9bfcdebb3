"""Assembled plans: the model experiment and the exploration report."""
