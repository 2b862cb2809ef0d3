"""sondar.streaming"""
