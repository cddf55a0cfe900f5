from setuptools import find_packages, setup

setup(name="millrace", version="0.1.0", packages=find_packages(include=["millrace", "millrace.*"]))
