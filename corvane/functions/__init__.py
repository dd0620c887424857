"""corvane.functions"""
