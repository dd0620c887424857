"""corvane.plans"""
