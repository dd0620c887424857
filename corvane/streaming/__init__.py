"""corvane.streaming"""
