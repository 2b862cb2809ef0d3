"""sondar.functions"""
