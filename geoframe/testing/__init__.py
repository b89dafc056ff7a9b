"""testing"""
