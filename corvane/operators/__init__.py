"""corvane.operators"""
