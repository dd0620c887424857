"""corvane.sources"""
