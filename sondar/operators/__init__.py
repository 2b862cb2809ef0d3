"""sondar.operators"""
